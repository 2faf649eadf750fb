"""F1 business events -> F2_CONT double-entry postings.

Plan shape: one scan of the event table, then a chain of broadcast hash joins
against size-checked rule frames (validity gate, entry fan-out, structure
lines, account rules). No step shuffles the event side, so a business event
name that holds a third of all rows costs no more than any other.

The account-rule match is one equi-join on six keys: the four structure keys,
the name of an attribute and its value. It needs one scan of the lines however
many attributes there are, and one probe per attribute however many rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ledgerly import contracts as C
from ledgerly.functions import (
    check_columns,
    entry_type,
    event_key,
    pick_column,
    posting_description,
)
from ledgerly.operators.rules import ACCOUNT_FIELDS, MATCH_KEYS, RuleSet

# Event columns every posting needs besides those the rules name.
EVENT_COLUMNS = ["TR_ID_EVNEG", "COD_SOCIEDAD", "COD_RAMO", "TR_COD_TIP_RECIB",
                 "TR_COD_EST_RECIB", "TR_NEGOCIO", "TR_COD_TIP_NEGOCIO",
                 "TR_COD_RAMO_CONT", "TR_COD_MOD_CONT"]


def rule_columns(f1: DataFrame, rules: RuleSet, carry: list[str] = ()) -> list[str]:
    """Event columns to read: fixed ones, every column a rule names, ``carry``.

    Raises ``UnknownColumnError`` when a rule names a column F1 lacks.
    """
    names = rules.names()
    attrs = check_columns(f1, names["attributes"], "account rules")
    amounts = check_columns(f1, names["amounts"], "entry amounts")
    aux = check_columns(f1, names["aux"], "chart of accounts")
    out: list[str] = []
    for c in [*EVENT_COLUMNS, *attrs, *amounts, *aux, *carry]:
        if c not in out:
            out.append(c)
    return out


def with_event_key(events: DataFrame) -> DataFrame:
    return events.withColumn("EVENT_NEG", event_key("TR_COD_TIP_RECIB", "TR_COD_EST_RECIB"))


def valid_events(events: DataFrame, rules: RuleSet) -> DataFrame:
    """Events whose business event name is in the master (semi join)."""
    return rules.lookup(with_event_key(events), rules.valid_event_names(), "valid_events",
                        ["EVENT_NEG"], "left_semi")


def expand_entries(valid: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per (event, accounting entry) pair; events without an entry drop."""
    return rules.lookup(valid, rules.relation(), "relation", ["EVENT_NEG"])


def expand_lines(entries: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per structure line of each entry, with the amount's column name."""
    return rules.lookup(entries, rules.amount_structure(), "amount_structure",
                        ["COD_ASIENTO", "COD_SOCIEDAD"])


def typed_text(value, dtype: DataType):
    """A value in the attribute's own type, as text: equal values of one type
    have equal text (``10`` and ``10.00`` on a decimal column)."""
    return value if isinstance(dtype, StringType) else value.try_cast(dtype).cast("string")


#: What a line looks its account rules up with.
RULE_KEYS = [f"R_{k}" for k in MATCH_KEYS] + ["R_CAMPO", "R_VALOR"]


def rule_side(lines: DataFrame, rules: RuleSet, attrs: list[str]) -> DataFrame:
    """Account rules by their lookup keys; values in the attribute's type."""
    types = {f.name: f.dataType for f in lines.schema.fields}
    value = F.lit(None).cast("string")
    for n in attrs:
        value = F.when(F.col("NOM_CAMPO") == n, typed_text(F.col("VALOR"), types[n])).otherwise(value)
    return rules.rule_accounts().select(
        *[F.col(k).alias(f"R_{k}") for k in MATCH_KEYS],
        F.col("NOM_CAMPO").alias("R_CAMPO"), value.alias("R_VALOR"),
        "COD_CUENTA", *ACCOUNT_FIELDS)


def match_key_columns(lines: DataFrame) -> dict:
    """A line's side of the structure keys."""
    return {f"R_{k}": lines[k].try_cast("int") if k == "NATURALEZA" else lines[k] for k in MATCH_KEYS}


def match_rules(lines: DataFrame, rules: RuleSet) -> DataFrame:
    """Attach every account rule whose attribute matches the event.

    Each line is paired with its few (attribute name, value) pairs and joined
    on six keys, so the cost of a line does not depend on the number of rules.
    A line matching two attributes of one rule yields two postings (any-of,
    with multiplicity).
    """
    attrs = check_columns(lines, rules.names()["attributes"], "account rules")
    types = {f.name: f.dataType for f in lines.schema.fields}
    pairs = [F.struct(F.lit(n).alias("name"), typed_text(F.col(f"`{n}`"), types[n]).alias("value"))
             for n in attrs] or [F.struct(F.lit(None).cast("string").alias("name"),
                                          F.lit(None).cast("string").alias("value"))]
    pair = F.explode(F.array(*pairs)) if len(pairs) > 1 else pairs[0]
    paired = lines.withColumn("_PAIR", pair).withColumns(
        {"R_CAMPO": F.col("_PAIR.name"), "R_VALOR": F.col("_PAIR.value"),
         **match_key_columns(lines)}).drop("_PAIR")
    return rules.lookup(paired, rule_side(lines, rules, attrs), "rule_accounts", RULE_KEYS).drop(*RULE_KEYS)


def posting_fields(matched: DataFrame, rules: RuleSet) -> dict:
    names = rules.names()
    aux_value = pick_column("CAMPO_AUX", names["aux"], "string")
    return {
        "TR_CUENTA_CONT": F.col("COD_CUENTA"),
        "TR_COD_TIP_EVCON": entry_type("COD_ASIENTO"),
        "TR_ID_EVCON": F.col("COD_ASIENTO"),
        "TR_NAT_EVCON": F.col("NATURALEZA"),
        "TR_CC_DES": posting_description("IND_TIPO", "DESC_CUENTA", aux_value),
        "TR_CC_IMP": pick_column("NOM_CAMPO", names["amounts"], C.MONEY),
    }


def describable_account():
    """Accounts with an integer kind, and an auxiliary column name whenever the
    kind asks for one."""
    kind = F.col("IND_TIPO").try_cast("int")
    return kind.isNotNull() & ((kind != 1) | F.col("CAMPO_AUX").isNotNull())


def describable():
    """Rows whose description can be built: a describable account and an amount
    column."""
    return describable_account() & F.col("NOM_CAMPO").isNotNull()


def matched_lines(f1: DataFrame, rules: RuleSet, carry: list[str] = ()) -> DataFrame:
    events = f1.select(*rule_columns(f1, rules, list(carry)))
    lines = expand_lines(expand_entries(valid_events(events, rules), rules), rules)
    return match_rules(lines, rules)


def postings(f1: DataFrame, rules: RuleSet, carry: list[str] = ()) -> DataFrame:
    """F1 -> F2_CONT (9 columns), plus the event columns listed in ``carry``.

    Rows whose account description cannot be built (see ``describable``) go
    to ``unmatched_events`` rather than failing the job.
    """
    m = matched_lines(f1, rules, carry).filter(describable())
    fields = posting_fields(m, rules)
    extra = [c for c in carry if c not in fields and c not in C.POSTINGS.fieldNames()]
    m = m.withColumns(fields)
    return m.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                      for f in C.POSTINGS.fields], *extra)
