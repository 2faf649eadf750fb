"""The end-to-end pipeline: raw receipts -> F0 -> F1 -> F2_CONT -> PS.

Every layer is a lazy DataFrame; nothing is materialised unless the caller
writes a layer. ``Layers`` builds each layer once per object, so several
outputs of one run share a single plan prefix.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.operators.enrich import business_events, product_dimension
from ledgerly.operators.ledger import ledger, ledger_from_events, posting_date_text
from ledgerly.operators.normalize import normalize_receipts
from ledgerly.operators.postings import postings
from ledgerly.operators.rules import RuleSet
from ledgerly.sinks import COMPRESSION, full_refresh
from ledgerly.sources.fixtures import fixture_tables
from ledgerly.sources.tables import raw_receipts

DEFAULT_POSTING_DATE = "24062024"


@dataclass
class Layers:
    raw: DataFrame
    rules: RuleSet
    product_dim_raw: DataFrame
    posting_date: dt.date | str | None = DEFAULT_POSTING_DATE
    keep: list[str] = field(default_factory=list)

    @cached_property
    def product_dim(self) -> DataFrame:
        return product_dimension(self.product_dim_raw)

    @cached_property
    def f0(self) -> DataFrame:
        return normalize_receipts(self.raw, keep=self.keep)

    @cached_property
    def f1(self) -> DataFrame:
        return business_events(self.f0, self.product_dim,
                               self.rules.max_broadcast_rows)

    @cached_property
    def postings(self) -> DataFrame:
        return postings(self.f1, self.rules)

    @cached_property
    def ledger(self) -> DataFrame:
        return ledger_from_events(self.f1, self.rules, self.posting_date)


def run_pipeline(raw: DataFrame, rules: RuleSet, product_dim_raw: DataFrame,
                 posting_date: dt.date | str | None = None) -> Layers:
    """All layers of one run over ``raw`` (lazy)."""
    return Layers(raw, rules.validate(), product_dim_raw, posting_date)


def fixture_layers(spark: SparkSession, sf_dir: str,
                   posting_date: str = DEFAULT_POSTING_DATE) -> Layers:
    """Layers over the receipts derived from the driver tables, with the
    fixture rule tables."""
    tabs = fixture_tables(spark)
    rules = RuleSet.from_tables(tabs)
    return run_pipeline(raw_receipts(spark, sf_dir), rules, tabs["product_dim"],
                        posting_date)


def _committed(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a completed write (its ``_SUCCESS`` marker)."""
    from ledgerly.sources.files import _fs
    fs, jvm = _fs(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))


def run_fingerprint(layers: Layers) -> str:
    """What a run depends on: every row of the receipts and of the rule and
    product tables (as multisets), and the posting date. One aggregation per
    table, combined before the shuffle."""
    r = layers.rules
    parts = [posting_date_text(layers.posting_date)]
    for df in (layers.raw, r.event_master, r.event_relation, r.entry_structure, r.entry_amounts,
               r.account_rules, r.chart_of_accounts, layers.product_dim_raw):
        low, high = (F.xxhash64(F.lit(i), *[F.col(f"`{c}`") for c in df.columns])
                     .cast("decimal(38,0)") for i in (0, 1))
        parts += map(str, df.agg(F.count(F.lit(1)), F.sum(low), F.sum(high)).first())
    return "/".join(parts)


def _mark(spark: SparkSession, path: str, run: str) -> None:
    """Note which run the layer at ``path`` belongs to (empty: none that could
    be resumed)."""
    spark.createDataFrame([(run,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}_run")


def _belongs(spark: SparkSession, path: str, run: str) -> bool:
    return (_committed(spark, path) and _committed(spark, f"{path}_run")
            and [r.value for r in spark.read.text(f"{path}_run").collect()] == [run])


def publish_layers(layers: Layers, base: str, resume: bool = False) -> dict[str, str]:
    """Full refresh of every layer under ``base``, each computed from the
    *stored* previous layer, as separately scheduled jobs would: the lineage
    is cut at every layer. With ``resume``, the layers that an unfinished run
    over the same inputs, rules and posting date has committed are kept, so it
    restarts at the first missing layer; anything else is written anew. The
    ledger uses the join form (postings x events on the event id) because both
    layers are read from storage."""
    spark = layers.raw.sparkSession
    run = run_fingerprint(layers) if resume else ""
    steps = [
        ("F0", C.F0, "f0", lambda prev: layers.f0),
        ("F1", C.F1, "f1", lambda prev: business_events(
            prev["F0"], layers.product_dim, layers.rules.max_broadcast_rows)),
        ("F2_CONT", C.POSTINGS, "f2_cont", lambda prev: postings(prev["F1"], layers.rules)),
        ("PS", C.LEDGER, "ps", lambda prev: ledger(prev["F2_CONT"], prev["F1"],
                                                   layers.posting_date, short_ids=True)),
    ]
    stored, paths = {}, {}
    for name, contract, sub, build in steps:
        path = f"{base.rstrip('/')}/{sub}"
        if not (resume and _belongs(spark, path, run)):
            _mark(spark, path, "")
            full_refresh(build(stored), contract, path)
            _mark(spark, path, run)
        paths[name] = path
        stored[name] = spark.read.parquet(path)
    return paths


def publish_bucketed_layers(layers: Layers, base: str, buckets: int,
                            name_prefix: str) -> dict[str, str]:
    """Store F1 and F2_CONT as external tables bucketed (and sorted) by the
    event id, then build PS from the stored tables: the postings x events join
    reads matching buckets side by side, with no shuffle of either layer.
    Pick ``buckets`` so one bucket of F1 is a comfortable task (~128-512 MB).
    Every task writes its rows to the buckets' files itself, without a shuffle;
    F2_CONT is computed from F1's buckets, whose tasks hold few buckets each.
    Returns the table names."""
    spark = layers.raw.sparkSession
    names = {"F1": f"{name_prefix}_f1", "F2_CONT": f"{name_prefix}_f2_cont"}

    def save(df, name, sub):
        (df.write.mode("overwrite").option("path", f"{base.rstrip('/')}/{sub}")
           .option("compression", COMPRESSION).bucketBy(buckets, "TR_ID_EVNEG").sortBy("TR_ID_EVNEG").saveAsTable(name))

    save(C.conform(layers.f1, C.F1), names["F1"], "f1")
    f1 = spark.table(names["F1"])
    save(C.conform(postings(f1, layers.rules), C.POSTINGS), names["F2_CONT"], "f2_cont")
    names["PS"] = f"{name_prefix}_ps"
    ps = ledger(spark.table(names["F2_CONT"]), f1, layers.posting_date)
    ps.write.mode("overwrite").option("path", f"{base.rstrip('/')}/ps").saveAsTable(names["PS"])
    return names
