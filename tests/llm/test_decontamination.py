import hashlib

from ledgerly.llm import decontamination as D
from ledgerly.llm.queries import op5_ngram_decontamination
from tests.llm.cases import contamination, crowded, folded_words, frame, sample_rows
from tests.llm.conftest import SF

ITEMS = [(1, " ".join(f"P{i}" for i in range(5, 25))), (2, "Quick brown, FOX!"), (3, ""), (4, None),
         (5, "quick brown fox"), (11, "漢字"), (None, "one")]


def test_query(spark, sf_docs, sf_items):
    got = {r["doc_id"]: r for r in op5_ngram_decontamination(spark, SF).collect()}
    for (doc, _), (n, hit, items) in zip(sf_docs, contamination(sf_docs, sf_items), strict=True):
        r = got[doc]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(items), hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(items).encode()).hexdigest()
    assert any(r["contaminated"] for r in got.values())


def bench(spark, items=None):
    return spark.createDataFrame(ITEMS if items is None else items, "item_id long, text string")


def expected(rows):
    return contamination(rows, ITEMS)


def test_edge_cases_in_one_block_and_in_many(spark):
    df = crowded(frame(spark))
    for size in (32 << 20, 400):
        rows = D.find_contamination(df, bench(spark), block_bytes=size).collect()
        want = expected([(r["doc_id"], r["text"]) for r in rows])
        assert [(r["n_words"], r["n_hit"], r["item_ids"]) for r in rows] == want
        assert len(rows) == len(sample_rows()) and rows[0]["Extra"] == "clash"
    assert D.find_contamination(df.limit(0), bench(spark)).count() == 0
    none = D.find_contamination(df, bench(spark, [(1, None)])).collect()
    assert {r["n_hit"] for r in none} == {0}


def test_blocks_are_held_one_at_a_time(spark, monkeypatch):
    live, most, made = set(), [], D._scan_udf

    def scan_udf(shared):
        live.add(shared)
        most.append(len(live))
        destroy = shared.destroy
        shared.destroy = lambda *a: (live.discard(shared), destroy(*a))
        return made(shared)

    monkeypatch.setattr(D, "_scan_udf", scan_udf)
    found = D.find_contamination(frame(spark), bench(spark), block_bytes=800)
    assert len(most) > 1 and max(most) == 1 and not live
    rows = found.collect()
    assert [(r["n_words"], r["n_hit"], r["item_ids"]) for r in rows] == expected(
        [(r["doc_id"], r["text"]) for r in rows])


def test_items_without_an_id_hit(spark):
    df = frame(spark, [(1, "all of this hits", "", "", 0), (2, "this does not", "", "", 0)])
    items = bench(spark, [(None, "All of THIS hits"), (7, "of this")])
    got = {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in D.find_contamination(df, items).collect()}
    assert got == {1: (4, ["7"]), 2: (0, [])}


def test_clashing_columns_come_back(spark):
    df = crowded(frame(spark))
    for mode in ("document", "span"):
        kept = D.remove_contamination(df, bench(spark), mode=mode)
        assert kept.columns == df.columns
        assert {(r["spans"], r["n_words"], r["Extra"]) for r in kept.collect()} == {("clash",) * 3}


def test_removal(spark):
    df = frame(spark)
    hit = {(r["doc_id"], r["text"]) for r in D.find_contamination(df, bench(spark)).collect() if r["n_hit"]}
    kept = D.remove_contamination(df, bench(spark))
    assert kept.columns == df.columns
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {
        (r["doc_id"], r["text"]) for r in df.collect()} - hit
    cut = {r["doc_id"]: r["text"] for r in D.remove_contamination(df, bench(spark), mode="span").collect()}
    assert cut[4] == "" and cut[3] is None and folded_words(cut[10])[:3] == ["before", "p0", "p1"]
    again = D.find_contamination(D.remove_contamination(df, bench(spark), mode="span"), bench(spark))
    assert {r["n_hit"] for r in again.collect()} == {0}
