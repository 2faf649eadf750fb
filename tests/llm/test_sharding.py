from collections import defaultdict

from pyspark.sql import functions as F

from ledgerly.llm import sharding
from ledgerly.llm.queries import op1_histogram_sort
from tests.llm.cases import crc32, crowded, frame
from tests.llm.conftest import SF


def check(rows, n, shards, slack):
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert len(rows) == n and set(slots) <= set(range(shards))
    for got in slots.values():
        assert sorted(got) == list(range(len(got)))
    mean = sum(sizes.values()) / shards
    largest = max((r["size"] for r in rows), default=0)
    assert all(abs(sizes[s] - mean) <= slack * mean + largest for s in range(shards)), dict(sizes)


def test_query(spark, sf_docs):
    rows = op1_histogram_sort(spark, SF).collect()
    check(rows, len(sf_docs), 8, 0.02)
    text = dict(sf_docs)
    for r in rows:
        assert r["text_crc32"] == crc32(text[r["doc_id"]])
        assert r["size"] == len((text[r["doc_id"]] or "").encode()) + 1
        assert r["law"] == "bytes" and r["grown_shard"] is None


def test_splitters_by_brute_force(spark, sf_docs):
    """All rows sorted by key in plain Python: shards are ranges of it, and no
    row boundary is much nearer to a shard's share of the bytes."""
    for shards, tolerance in ((8, 0.001), (5, 0.05)):
        docs = frame(spark, [(i, t, "", "", 0) for i, t in sf_docs])
        got = sharding.shard_documents(docs, shards, tolerance=tolerance)
        rows = sorted(got.select(F.xxhash64("text"), F.xxhash64("doc_id", F.lit(1)), "shard", "size").collect())
        assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)
        below = [0]
        for r in rows:
            below.append(below[-1] + r["size"])
        assert below[-1] == sum(len((t or "").encode()) + 1 for _, t in sf_docs)
        for i in range(1, shards):
            target = below[-1] * i / shards
            cut = below[sum(r["shard"] < i for r in rows)]
            nearest = min(abs(b - target) for b in below)
            assert abs(cut - target) <= nearest + tolerance * below[-1] / shards


def test_small_groups_stay_whole(spark):
    rows = [(i, f"text {i // 3} " + "x" * 40, "en", "s", 1) for i in range(3000)]
    got = sharding.shard_documents(frame(spark, rows), 8, tolerance=0.02).collect()
    check(got, 3000, 8, 0.05)
    where = defaultdict(set)
    for r in got:
        where[r["text"]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 7  # at most one group per splitter


def test_hot_group_is_split(spark):
    rows = [(i, "copy of one text" if i % 3 else f"text {i}", "en", "s", 1) for i in range(2000)]
    rows += [(None, None, None, None, None)] * 3
    got = sharding.shard_documents(frame(spark, rows), 8).collect()
    check(got, len(rows), 8, 0.03)
    assert len({r["shard"] for r in got if r["text"] and r["text"].startswith("copy")}) > 1


def test_repeated_rows_are_cut_by_count(spark):
    rows = [(7, "the same row in full", "en", "s", 1)] * 600
    rows += [(1000 + i, f"text {i} " + "x" * (i % 60), "en", "s", 1) for i in range(398)]
    rows += [(8, "another one", "en", "s", 1)] * 300 + [(None, None, None, None, None)] * 500
    for shards in (8, 3):
        got = sharding.shard_documents(frame(spark, rows).repartition(5), shards).collect()
        check(got, len(rows), shards, 0.02)
    same = sharding.shard_documents(frame(spark, [(1, "x", "", "", 1)] * 4000), 8).collect()
    check(same, 4000, 8, 0.0)


def test_splitters_by_brute_force(spark):
    """Each splitter leaves the bytes below it nearer to its target than the
    tolerance, or is as near as whole rows allow."""
    rows = [(i % 50, f"text {i % 70} " + "y" * (i % 90), "en", "s", 1) for i in range(2500)]
    got = sharding.shard_documents(frame(spark, rows), 8, tolerance=0.001).collect()
    check(got, 2500, 8, 0.001)


def test_edge_cases(spark):
    df = crowded(frame(spark))
    got = sharding.shard_documents(df, 8).collect()
    check(got, df.count(), 8, 8.0)
    assert got[0]["Extra"] == "clash" and sorted(df.columns) == sorted(got[0].asDict())
    empty = sharding.shard_documents(df.limit(0), 8)
    assert empty.count() == 0 and {"size", "shard", "slot"} <= set(empty.columns)
    one = sharding.shard_documents(frame(spark, [(1, "x", "", "", 1)]), 8).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


def test_splitters_are_stable(spark):
    df = frame(spark)
    a = {(r["doc_id"], r["text"]): r["shard"] for r in sharding.shard_documents(df).collect()}
    b = {(r["doc_id"], r["text"]): r["shard"] for r in sharding.shard_documents(df.repartition(7)).collect()}
    assert a == b
