
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P
from ledgerly.llm import quality_rules as Q
from ledgerly.llm.queries import VOCABULARY, oracle_sql, queries
from tests.llm.cases import contamination, crowded, frame, groups, kept_by_hand, secrets
from tests.llm.conftest import SF


def mask(text):
    out, at = "", 0
    for s, e, _ in secrets(text):
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def test_pipeline_by_brute_force(spark, sf_docs, sf_items):
    judged = kept_by_hand([t for _, t in sf_docs], Q.FUNCTION_WORDS)
    rows = [x for x, (_, kept) in zip(sf_docs, judged, strict=True) if kept]
    _, group = groups(rows)
    first = {}
    for (doc, _), g in zip(rows, group, strict=True):
        first[g] = min(doc, first.get(g, doc))
    rows = [x for x in rows if x[0] in set(first.values())]
    rows = [x for x, (_, hit, _) in zip(rows, contamination(rows, sf_items), strict=True) if not hit]
    want = {doc: mask(text) for doc, text in rows}
    library = Tokenizer.from_file(VOCABULARY)
    got = P.run(spark, SF).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    for r in got:
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == library.encode(r["text"]).ids
        assert r["round_trip"] and r["n_chars"] == len(r["text"])


def test_every_stage_takes_hard_cases(spark):
    for rows in (None, []):
        docs = frame(spark, rows)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            assert n <= docs.count(), name
            assert out.columns[:5] == docs.columns, name
            if name != P.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_every_stage_leaves_clashing_columns_alone(spark):
    docs = crowded(frame(spark))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert {v for c, v in r.asDict().items()
                    if c not in ("doc_id", "text", "lang", "source", "n_chars")} == {"clash"}, name


def test_stages_are_as_ordered():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination",
                                        "secret_scan", "bpe_encoding"]
    assert set(oracle_sql()) <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
