"""Data-driven accounting rules.

``RuleSet`` holds the six rule tables. They are configuration: small, but read
from storage, so their size is *checked* (one small counting job) before any of them
is broadcast; a table over ``max_broadcast_rows`` or ``max_broadcast_bytes`` is
joined by a salted shuffle instead (``RuleSet.lookup``).
Everything derived from the rules (amount structure, account cells, chart
join) is computed once here, so the event side is scanned exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.operators.skew import salted_join

# The keys of the rule tables.
STRUCTURE_KEYS = ["COD_SOCIEDAD", "ID_ESTRUCTURA", "COD_ASIENTO", "NOM_IMPORTE"]
RULE_GROUP_KEYS = ["COD_SOCIEDAD", "ID_CUEN_ASIEN", "ID_ESTRUCTURA", "COD_ASIENTO",
                   "NATURALEZA", "COD_CUENTA"]
MATCH_KEYS = ["COD_SOCIEDAD", "ID_ESTRUCTURA", "COD_ASIENTO", "NATURALEZA"]
ACCOUNT_FIELDS = ["DESC_CUENTA", "IND_TIPO", "CAMPO_AUX"]

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
#: Event columns whose hash deals a hot key's rows over tasks.
SPREAD_BY = ["TR_ID_EVNEG", "COD_RECIBO"]
#: Bytes of a row besides its texts, per column.
COLUMN_BYTES = 16


class RuleError(ValueError):
    """The rule tables are inconsistent."""


@dataclass
class RuleSet:
    event_master: DataFrame
    event_relation: DataFrame
    entry_structure: DataFrame
    entry_amounts: DataFrame
    account_rules: DataFrame
    chart_of_accounts: DataFrame
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
    _sizes: dict = field(default=None, repr=False)
    _widths: dict = field(default=None, repr=False)
    _names: dict = field(default=None, repr=False)
    _names_null: bool = field(default=False, repr=False)
    _dups: list = field(default=None, repr=False)

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame], **kw) -> RuleSet:
        return cls(tables["event_master"], tables["event_relation"],
                   tables["entry_structure"], tables["entry_amounts"],
                   tables["account_rules"], tables["chart_of_accounts"], **kw)

    # ---- derived rule frames -------------------------------------------
    def valid_event_names(self) -> DataFrame:
        return self.event_master.select("EVENT_NEG")

    def relation(self) -> DataFrame:
        return self.event_relation.select("EVENT_NEG", "COD_ASIENTO")

    def amount_structure(self) -> DataFrame:
        """Entry structure lines with the event column holding each amount."""
        basic = self.entry_structure.select(*STRUCTURE_KEYS, "NATURALEZA")
        amounts = self.entry_amounts.select(*STRUCTURE_KEYS, "NOM_CAMPO")
        return basic.join(amounts, STRUCTURE_KEYS, "inner")

    def account_cells(self) -> DataFrame:
        """Account rules in long form: one row per (rule, attribute) cell.

        Rules without an account are dropped; a repeated cell keeps its
        smallest value (a deterministic choice), and an empty cell is dropped.
        """
        r = self.account_rules.filter(F.col("COD_CUENTA").isNotNull())
        return (r.groupBy(*RULE_GROUP_KEYS, "NOM_CAMPO")
                 .agg(F.min("VALOR").alias("VALOR"))
                 .filter(F.col("VALOR").isNotNull()))

    def rules_wide(self, names: list[str] | None = None) -> DataFrame:
        """Rules pivoted by attribute name, one column per attribute."""
        names = names if names is not None else self.names()["attributes"]
        r = self.account_rules.filter(F.col("COD_CUENTA").isNotNull())
        return r.groupBy(*RULE_GROUP_KEYS).pivot("NOM_CAMPO", names).agg(F.min("VALOR"))

    def rule_accounts(self) -> DataFrame:
        """Account cells joined to the chart of accounts on the account
        number alone (a number present in two companies yields two rows)."""
        chart = self.chart_of_accounts.select("NUM_CUENTA", *ACCOUNT_FIELDS)
        cells = self.account_cells()
        return (cells.join(chart, cells.COD_CUENTA == chart.NUM_CUENTA, "inner")
                     .drop("NUM_CUENTA"))

    # ---- plan-time metadata ---------------------------------------------
    def _frames(self) -> dict[str, DataFrame]:
        return {
            "valid_events": self.valid_event_names(),
            "relation": self.relation(),
            "amount_structure": self.amount_structure(),
            "rule_accounts": self.rule_accounts(),
        }

    def _metadata(self) -> None:
        """One job over the base rule tables (global aggregates, no joins):
        row counts, the event columns they refer to (at most as many as an
        event has, and one name that is none), repeated event names.

        A derived frame's size is bounded by the product of its inputs'
        counts; only when that bound exceeds ``max_broadcast_rows`` is the
        derived frame itself counted.
        """
        def count_row(df, key):
            return df.agg(F.count(F.lit(1)).alias("n"), F.max(_row_bytes(df)).alias("w")).select(
                F.lit(key).alias("k"), "n", F.array().cast("array<string>").alias("names"),
                F.lit(0).alias("has_null"), F.lit(1).cast("long").alias("max_rep"), "w")

        def names_row(df, key, col):
            # per distinct name its row count; the names themselves are kept
            # only where they are event columns, plus one other to report
            name = F.col("v")
            known = name.isin(*C.F1.fieldNames())
            per_name = df.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"),
                                                             F.max(_row_bytes(df)).alias("w"))
            return per_name.agg(
                F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n"), F.max("w").alias("w"),
                F.sort_array(F.collect_set(F.when(known, name))).alias("names"),
                F.min(F.when(~known, name)).alias("unknown"),
                F.coalesce(F.max(name.isNull().cast("int")), F.lit(0)).alias("has_null"),
            ).select(F.lit(key).alias("k"), "n", F.when(
                F.col("unknown").isNull(), F.col("names")).otherwise(
                F.array_append("names", "unknown")).alias("names"), "has_null",
                F.lit(1).cast("long").alias("max_rep"), "w")

        def repeats_row(df, key, col):
            per_name = df.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"),
                                                             F.max(_row_bytes(df)).alias("w"))
            return per_name.agg(
                F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n"), F.max("w").alias("w"),
                F.coalesce(F.max("c"), F.lit(0)).cast("long").alias("max_rep"),
            ).select(F.lit(key).alias("k"), "n", F.array().cast("array<string>").alias("names"),
                     F.lit(0).alias("has_null"), "max_rep", "w")

        parts = [count_row(self.event_relation, "event_relation"),
                 count_row(self.entry_structure, "entry_structure"),
                 repeats_row(self.event_master, "event_master", "EVENT_NEG"),
                 names_row(self.entry_amounts, "entry_amounts", "NOM_CAMPO"),
                 names_row(self.account_rules, "account_rules", "NOM_CAMPO"),
                 names_row(self.chart_of_accounts, "chart_of_accounts", "CAMPO_AUX")]
        rows = {r.k: r for r in reduce(DataFrame.unionByName, parts).collect()}
        n = {k: r.n for k, r in rows.items()}
        self._dups = ["<repeated>"] if rows["event_master"].max_rep > 1 else []
        self._names = {"attributes": list(rows["account_rules"].names),
                       "amounts": list(rows["entry_amounts"].names),
                       "aux": list(rows["chart_of_accounts"].names)}
        self._names_null = bool(rows["account_rules"].has_null)
        bounds = {"valid_events": n["event_master"], "relation": n["event_relation"],
                  "amount_structure": n["entry_structure"] * n["entry_amounts"],
                  "rule_accounts": n["account_rules"] * n["chart_of_accounts"]}
        w = {k: r.w or 0 for k, r in rows.items()}
        self._widths = {"valid_events": w["event_master"], "relation": w["event_relation"],
                        "amount_structure": w["entry_structure"] + w["entry_amounts"],
                        "rule_accounts": w["account_rules"] + w["chart_of_accounts"]}
        frames = self._frames()
        self._sizes = {k: (b if b <= self.max_broadcast_rows
                           else frames[k].limit(self.max_broadcast_rows + 1).count())
                       for k, b in bounds.items()}

    def names(self) -> dict[str, list[str]]:
        """Column names the rules refer to (cached)."""
        if self._names is None:
            self._metadata()
        if self._names_null:
            raise RuleError("account rule with a NULL attribute name")
        return self._names

    def sizes(self) -> dict[str, int]:
        """Row counts of every frame that may be broadcast (cached)."""
        if self._sizes is None:
            self._metadata()
        return self._sizes

    def is_small(self, name: str) -> bool:
        """The frame's rows and bytes are within the broadcast bounds."""
        rows = self.sizes()[name]
        return (rows <= self.max_broadcast_rows
                and rows * self._widths[name] <= self.max_broadcast_bytes)

    def small(self, name: str, df: DataFrame) -> DataFrame:
        """``broadcast(df)`` when its checked size is within the bounds."""
        return F.broadcast(df) if self.is_small(name) else df

    def lookup(self, large: DataFrame, small: DataFrame, name: str, keys: list[str],
               how: str = "inner") -> DataFrame:
        """``large`` joined with the rule frame ``name`` (or what was derived
        from it) on equally named keys: a broadcast join where the frame's
        checked size allows, else a salted shuffle join, in which no key of the
        events, however many rows it has, is left to one task."""
        if self.is_small(name):
            return large.join(F.broadcast(small), keys, how)
        spread = [c for c in SPREAD_BY if c in large.columns]
        return salted_join(large, small, keys, spread or large.columns, how)

    def validate(self) -> RuleSet:
        """Reject rule tables whose joins would silently duplicate events or
        that name no column."""
        if self._sizes is None:
            self._metadata()
        if self._dups:
            raise RuleError("event master repeats an event name")
        self.names()
        return self


def fixture_rules(spark: SparkSession, **kw) -> RuleSet:
    from ledgerly.sources.fixtures import fixture_tables
    return RuleSet.from_tables(fixture_tables(spark), **kw)


def _row_bytes(df: DataFrame):
    """Upper bound of a row's size: its texts and a fixed part per column."""
    texts = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns])
    return F.octet_length(texts) + F.lit(COLUMN_BYTES * len(df.columns))


def is_small(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """Whether a reference frame is within the broadcast bounds, by one job that
    reads no more than the rows allowed and one."""
    n, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(_row_bytes(df))).first()
    return n <= max_rows and (size or 0) <= max_bytes


__all__ = ["RuleSet", "RuleError", "fixture_rules", "is_small"]
