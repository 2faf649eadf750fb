import random

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerly.llm import simhash as S
from ledgerly.llm.components import connected_components
from ledgerly.llm.queries import op10_simhash_bk_trees
from tests.llm.cases import crowded, frame, groups, sample_rows, simhash
from tests.llm.conftest import SF

SF01 = "/root/testdata/sf0.01"


def check(rows, got):
    """rows: (doc_id, text); got: doc_id -> (fingerprint, component_id)."""
    fp, group = groups(rows)
    least = {}
    for (doc, _), g in zip(rows, group, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    for (doc, _), f, g in zip(rows, fp, group, strict=True):
        if doc is not None:
            assert got[doc] == (f, least[g])


def test_query(spark, sf_docs):
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"])
           for r in op10_simhash_bk_trees(spark, SF).collect()}
    check(sf_docs, got)


def test_edge_cases(spark):
    df = crowded(frame(spark))
    found = S.near_duplicates(df).collect()
    assert len(found) == len(sample_rows())
    check([(d, t) for d, t, *_ in sample_rows()],
          {r["doc_id"]: (r["simhash"] & (1 << 64) - 1, r["component_id"]) for r in found})
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    df = crowded(frame(spark))
    rows = [(d, t) for d, t, *_ in sample_rows()]
    kept = S.drop_near_duplicates(df).collect()
    assert sorted(kept[0].asDict()) == sorted(df.columns)
    _, group = groups(rows)
    want = {}
    for (doc, _), g in zip(rows, group, strict=True):
        if doc is not None:
            want[g] = min(doc, want.get(g, doc))
    assert sorted(r["doc_id"] for r in kept) == sorted(want.values())
    nameless = frame(spark, [(None, "a b c d", "", "", 1), (None, "a b c d", "", "", 1), (None, "q", "", "", 1)])
    assert sorted(r["text"] for r in S.drop_near_duplicates(nameless).collect()) == ["a b c d", "q"]
    assert S.drop_near_duplicates(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(0, 4))
def test_bk_tree_finds_all_in_radius(seed, radius):
    rnd = random.Random(seed)
    base = rnd.getrandbits(64)
    values = {base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))) for _ in range(60)}
    tree = S.BKTree()
    for v in values:
        tree.add(v)
    probe = base ^ 5
    got = {tree.values[i] for i in tree.within(probe, radius)}
    assert got == {v for v in values if (v ^ probe).bit_count() <= radius}


def test_masks_leave_no_pair_out():
    rnd = random.Random(1)
    for radius, agree, width in [(1, 4, 64), (2, 4, 64), (3, 4, 64), (2, 1, 12), (2, 1, 64), (2, 2, 27),
                                 (2, 8, 64), (2, 1, 0)]:
        masks = S.shard_masks(radius, agree, width)
        assert all(m.bit_count() <= width for m in masks)
        for _ in range(500):
            a = rnd.getrandbits(64)
            b = a ^ sum(1 << x for x in rnd.sample(range(64), radius))
            assert any(a & m == b & m for m in masks)


def test_trees_hold_the_given_documents(spark):
    marked = S.fingerprint_documents(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text"))
    values = [r[0] for r in marked.select("simhash").distinct().collect()]
    values = sorted({*values, *(v ^ 5 << i % 60 for i, v in enumerate(values[::7]))})  # and neighbours
    df = spark.createDataFrame([(v,) for v in values], "simhash long")
    sizes = [r["count"] for r in S.sharded(df).groupBy("table", "shard").count().collect()]
    assert sum(sizes) == 3 * len(values) and 32 <= sum(sizes) / len(sizes) <= 128
    want = all_pairs(values)
    assert want != {v: v for v in values}
    assert components(spark, S.fingerprint_links(df), values) == want


def test_oversized_shards_go_on(spark):
    rnd = random.Random(9)
    base = rnd.getrandbits(64)  # two thirds of all differ from one value in a few places only
    values = {base ^ sum(1 << x for x in rnd.sample(range(64), rnd.randrange(7))) for _ in range(400)}
    values |= {rnd.getrandbits(64) for _ in range(200)}
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "simhash long")
    want = all_pairs(values)
    for size, largest in ((8, 4096), (8, 40), (64, 5), (1000, 10)):
        dealt = S.sharded(df, tree_size=size, max_tree=largest)
        tables = dealt.select("table").distinct().count()
        assert tables == 3 if largest == 4096 else tables > 3
        links = S.fingerprint_links(df, tree_size=size, max_tree=largest)
        assert components(spark, links, values) == want, (size, largest)


def all_pairs(values):
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {v: root(v) for v in values}


def components(spark, links, values):
    roots = {r["a"]: r["root"] for r in connected_components(links).collect()}
    return {v: roots.get(v, v) for v in values}


def test_links_of_planted_neighbours(spark):
    rnd = random.Random(5)
    values = set()
    for _ in range(40):
        v = rnd.getrandbits(64)
        values.add(v)
        for _ in range(rnd.randrange(5)):  # chains, two bits a step
            v ^= sum(1 << x for x in rnd.sample(range(64), 2))
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "simhash long")
    roots = {r["a"]: r["root"] for r in connected_components(S.fingerprint_links(df)).collect()}
    parent = {v: v for v in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    assert {v: roots.get(v, v) for v in signed} == {v: root(v) for v in signed}


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (3, 2)]
    got = {r["a"]: r["root"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_equal_brute_force():
    texts = [t for _, t, *_ in sample_rows()]
    assert [int(x) & (1 << 64) - 1 for x in S.fingerprints(texts, 3)] == [simhash(t) for t in texts]
