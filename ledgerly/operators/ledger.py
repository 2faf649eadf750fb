"""Postings -> PS ledger lines (sum by eleven keys).

``ledger_from_events`` carries the five event columns the ledger needs through
the postings chain, so the ledger is a single hash aggregation (partial sums on
the map side, one shuffle of already-combined rows) with no join back to the
event table. ``ledger`` takes stored postings and events and joins them on the
event id, for when the two layers are read from storage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.operators.postings import postings
from ledgerly.operators.rules import RuleSet

# Columns, keys and layout of the ledger interface.
LEDGER_EVENT_COLUMNS = ["COD_SOCIEDAD", "COD_DIVISA", "CON_LIQUIDACION", "COD_MEDIADOR",
                        "TR_COD_AGENCIA"]
LEDGER_POSTING_COLUMNS = ["TR_ID_EVNEG", "TR_COD_TIP_EVCON", "TR_ID_EVCON", "TR_NAT_EVCON",
                          "TR_CUENTA_CONT", "TR_CC_IMP", "TR_COD_RAMO_CONT",
                          "TR_COD_MOD_CONT"]
LEDGER_KEYS = ["COD_SOCIEDAD", "TR_COD_TIP_EVCON", "TR_ID_EVCON", "COD_DIVISA",
               "CON_LIQUIDACION", "TR_NAT_EVCON", "COD_MEDIADOR", "TR_CUENTA_CONT",
               "TR_COD_AGENCIA", "TR_COD_RAMO_CONT", "TR_COD_MOD_CONT"]

# PS field <- aggregated column; "" marks fields the interface leaves empty.
LEDGER_FIELDS = {
    "COD_SOCIEDAD": "COD_SOCIEDAD",
    "CLASE_DOC": "TR_COD_TIP_EVCON",
    "REFER": "TR_ID_EVCON",
    "DIV": "COD_DIVISA",
    "TEX_CABECERA": "CON_LIQUIDACION",
    "FECHA_CONTAB": None,
    "CLAVE_CONTAB": "TR_NAT_EVCON",
    "TERC": "COD_MEDIADOR",
    "NOM_1": "",
    "NOM_2": "",
    "POBL": "",
    "NIF": "",
    "NUM_CUENTA": "TR_CUENTA_CONT",
    "IMP": "TR_CC_IMP",
    "DIVIS": "TR_COD_AGENCIA",
    "C_COSTE": "",
    "ASIG": "",
    "TEXT": "",
    "RAMO_CON": "TR_COD_RAMO_CONT",
    "CANL": "",
    "INDICADOR_CME": "",
    "MODALIDAD_CON": "TR_COD_MOD_CONT",
}


def posting_date_text(posting_date: dt.date | str | None = None) -> str:
    """``ddMMyyyy``; default today (driver clock)."""
    if posting_date is None:
        posting_date = dt.date.today()
    if isinstance(posting_date, str):
        return posting_date
    return posting_date.strftime("%d%m%Y")


def ledger_lines(wide: DataFrame, posting_date: dt.date | str | None = None) -> DataFrame:
    """Sum posting amounts by the eleven ledger keys and lay out PS.

    NULL keys form their own group; a sum that overflows decimal(13,2)
    becomes NULL instead of failing.
    """
    agg = wide.groupBy(*LEDGER_KEYS).agg(
        F.sum("TR_CC_IMP").try_cast(C.MONEY).alias("TR_CC_IMP"))
    return _layout(agg, posting_date)


# Signed partial sums: amount sum, posting count and non-NULL amount count,
# each weighted by the row's sign (+1 added, -1 retracted).
PARTIAL_COLUMNS = ["P_SUM", "P_ROWS", "P_AMOUNTS"]


def signed_partials(wide: DataFrame, sign: str | None = None) -> DataFrame:
    """Per-key partial sums of postings; ``sign`` names a +1/-1 column
    (absent: every posting counts +1). Partials from any number of batches or
    corrections add up to the ledger exactly (decimal sums)."""
    s = F.col(sign) if sign else F.lit(1)
    amount = F.col("TR_CC_IMP")
    return wide.groupBy(*LEDGER_KEYS).agg(
        F.sum(amount * s).alias("P_SUM"),
        F.sum(s).cast("long").alias("P_ROWS"),
        F.sum(F.when(amount.isNotNull(), s).otherwise(0)).cast("long").alias("P_AMOUNTS"))


def ledger_from_partials(partials: DataFrame,
                         posting_date: dt.date | str | None = None) -> DataFrame:
    """PS from signed partials: groups whose postings all cancelled vanish,
    a group whose amounts are all NULL stays NULL."""
    agg = (partials.groupBy(*LEDGER_KEYS)
           .agg(*[F.sum(c).alias(c) for c in PARTIAL_COLUMNS])
           .filter(F.col("P_ROWS") != 0)
           .withColumn("TR_CC_IMP", F.when(F.col("P_AMOUNTS") != 0, F.col("P_SUM"))
                       .try_cast(C.MONEY)))
    return _layout(agg, posting_date)


def _layout(agg: DataFrame, posting_date: dt.date | str | None) -> DataFrame:
    date_text = posting_date_text(posting_date)
    cols = []
    for name, src in LEDGER_FIELDS.items():
        if src is None:
            e = F.lit(date_text)
        elif src == "":
            e = F.lit("")
        else:
            e = F.col(src)
        cols.append(e.cast(C.LEDGER[name].dataType).alias(name))
    return agg.select(*cols)


def short_id(name: str):
    """An event id for a shuffle: the 32 bytes of 64 lower-case hex digits, any other
    text by its own bytes and 33 more, which no such id has."""
    raw = F.unhex(name)
    text = F.concat(F.encode(name, "utf-8"), F.lit(bytes(33)))
    return F.when((F.length(name) == 64) & (F.lower(F.hex(raw)) == F.col(name)), raw).otherwise(text)


def posting_lineage(postings_df: DataFrame, events: DataFrame, short_ids: bool = False) -> DataFrame:
    """Postings joined to their event's ledger columns on the event id.

    An id hashes every event column joined here (``EVENT_ID_PARTS``; the agency
    through its code), so rows that share an id are equal in all of them. Their
    postings are already there once each, so the event side keeps one row per
    id (the dedup and the join use the same hash partitioning on the id).
    ``short_ids`` shuffles ids as bytes and gives them back in that form
    (tables bucketed by the id are joined without a shuffle by the id itself).
    """
    p = postings_df.select(*LEDGER_POSTING_COLUMNS)
    e = events.select("TR_ID_EVNEG", *LEDGER_EVENT_COLUMNS)
    if short_ids:
        p, e = (df.withColumn("TR_ID_EVNEG", short_id("TR_ID_EVNEG")) for df in (p, e))
    return p.join(e.dropDuplicates(["TR_ID_EVNEG"]), "TR_ID_EVNEG", "inner")


def ledger(postings_df: DataFrame, events: DataFrame,
           posting_date: dt.date | str | None = None, short_ids: bool = False) -> DataFrame:
    """PS from stored F2_CONT and F1 layers."""
    return ledger_lines(posting_lineage(postings_df, events, short_ids), posting_date)


def ledger_from_events(f1: DataFrame, rules: RuleSet,
                       posting_date: dt.date | str | None = None) -> DataFrame:
    """PS straight from F1: postings carry the event columns, no join back."""
    wide = postings(f1, rules, carry=LEDGER_EVENT_COLUMNS)
    return ledger_lines(wide, posting_date)


CHANGE_SIGN = "_SIGN"


def ledger_corrections(changed_events: DataFrame, rules: RuleSet,
                       change_col: str = "_change_type") -> DataFrame:
    """Signed partials for a change set of F1 events: deleted rows and update
    preimages retract their postings (-1), inserts and postimages add (+1).
    Append them to the partials of the previous ledger to get the new one."""
    sign = F.when(F.col(change_col).isin("delete", "update_preimage"), F.lit(-1)) \
            .otherwise(F.lit(1))
    ev = changed_events.withColumn(CHANGE_SIGN, sign)
    wide = postings(ev, rules, carry=LEDGER_EVENT_COLUMNS + [CHANGE_SIGN])
    return signed_partials(wide, CHANGE_SIGN)
