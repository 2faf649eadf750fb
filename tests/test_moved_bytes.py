"""What the profiles, diffs and stored layers exchange, and that they stay exact."""

import glob

from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.operators.changes import snapshot_changes
from ledgerly.operators.counts import receipt_key_profile
from ledgerly.operators.ledger import LEDGER_EVENT_COLUMNS, LEDGER_POSTING_COLUMNS, ledger, posting_lineage

SCHEMA = "k string, v string, w int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_key_profile_reads_once(spark):
    data = [("a", None, 1), ("a", None, 1), ("a", "1", None), (None, "1", 1), (None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    profile = receipt_key_profile(df, "k")
    assert tuple(profile.first()) == (5, 4, 1)
    assert tuple(receipt_key_profile(df.limit(0), "k").first()) == (0, 0, 0)
    assert plan(profile).count("Scan ExistingRDD") + plan(profile).count("LocalTableScan") == 1


OLD = [("a", "1", 1)] * 3 + [("b", "1", 1), (None, "1", 1), (None, None, 2), ("d", "4", 4), ("f", "1", 1)]
NEW = [("a", "1", 1)] + [("b", "2", 1)] * 2 + [(None, "1", 1), (None, None, 3), ("e", "5", 5), ("f", "1", 1)]
CHANGES = [("a", "1", 1, "delete")] * 2 + [("b", "1", 1, "update_preimage")] + [
    ("b", "2", 1, "update_postimage")] * 2 + [
    (None, None, 2, "update_preimage"), (None, None, 3, "update_postimage"),
    ("d", "4", 4, "delete"), ("e", "5", 5, "insert")]


def test_computed_rows_are_exchanged_once(spark):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    changes = snapshot_changes(old, new, ["k"])
    assert sum("Exchange" in line for line in plan(changes).splitlines()) == 1
    assert rows(changes) == sorted(CHANGES, key=str)


def test_digests_first_keep_all_changes(spark):
    """Rows that differ only in a column the caller does not use are changes too."""
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    changes = snapshot_changes(old, new, ["k"], digest_first=True)
    assert rows(changes) == sorted(CHANGES, key=str)
    assert rows(changes.select("k", "_change_type")) == sorted([(c[0], c[3]) for c in CHANGES], key=str)


def test_short_ids_join_as_the_ids(spark):
    ids = ["ab" * 32, "AB" * 32, "ab" * 31, "zz" * 32, "", "é" * 64, None]
    events = spark.createDataFrame([(i, *[f"{n}"] * len(LEDGER_EVENT_COLUMNS)) for n, i in enumerate(ids + ids)],
                                   ", ".join(f"{c} string" for c in ["TR_ID_EVNEG", *LEDGER_EVENT_COLUMNS]))
    events = events.withColumns({c: F.coalesce(F.length("TR_ID_EVNEG").cast("string"), F.lit("-"))
                                 for c in LEDGER_EVENT_COLUMNS})
    lines = spark.createDataFrame([(i, *[f"{n}"] * (len(LEDGER_POSTING_COLUMNS) - 1)) for n, i in enumerate(ids + ids)],
                                  ", ".join(f"{c} string" for c in LEDGER_POSTING_COLUMNS))
    lines = lines.withColumn("TR_CC_IMP", F.col("TR_CC_IMP").cast(C.MONEY))
    got, want = (posting_lineage(lines, events, short_ids=s).drop("TR_ID_EVNEG") for s in (True, False))
    assert rows(got) == rows(want) and got.count() == 12
    assert rows(ledger(lines, events, "01012024", short_ids=True)) == rows(ledger(lines, events, "01012024"))


def test_stored_layers_are_zstd(spark, tmp_path):
    from ledgerly.sinks import full_refresh
    schema = C.POSTINGS
    full_refresh(spark.createDataFrame([], schema), schema, str(tmp_path / "empty"))
    assert glob.glob(str(tmp_path / "empty" / "*.zstd.parquet"))


def test_bucketed_layers_are_written_without_a_shuffle(spark, layers, tmp_path, monkeypatch):
    from ledgerly.plans.layers import publish_bucketed_layers, run_pipeline
    lay = run_pipeline(layers.raw.limit(40).localCheckpoint(), layers.rules, layers.product_dim_raw, "24062024")
    shuffled = []
    real = type(lay.raw).repartition
    monkeypatch.setattr(type(lay.raw), "repartition",
                        lambda self, *a: shuffled.append(a) or real(self, *a))
    names = publish_bucketed_layers(lay, str(tmp_path), 4, "moved_bytes")
    try:
        assert shuffled == []
        assert rows(spark.table(names["PS"])) == rows(lay.ledger)
    finally:
        for name in names.values():
            spark.sql(f"drop table {name}")
