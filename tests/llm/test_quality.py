import math
import re
import zlib

import duckdb

from ledgerly.llm import quality_model as M
from ledgerly.llm import quality_rules as Q
from ledgerly.llm.queries import op6_rule_ensemble, op8_weak_supervision
from tests.llm.cases import crowded, fitted_by_row, frame, kept_by_hand, rule_counts, sample_rows, words
from tests.llm.conftest import SF

BIG = "/root/testdata/sf0.01"


def labels(folder):
    return dict(duckdb.sql(f"select doc_id, quality from '{folder}/labels.parquet'").fetchall())


def test_op8_counts(spark, sf_docs):
    got = {r["doc_id"]: r for r in op8_weak_supervision(spark, SF).collect()}
    for doc, text in sf_docs:
        r, want = got[doc], rule_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_op8_agrees_with_labels(spark):
    known = labels(BIG)
    got = [(r["kept"], r["base_failed"], known[r["doc_id"]]) for r in
           op8_weak_supervision(spark, BIG).collect() if r["doc_id"] in known]
    judged = [(kept, good) for kept, failed, good in got if not failed]
    assert sum(kept == bool(good) for kept, good in judged) / len(judged) > 0.97


def test_expectation_maximisation_by_brute_force():
    """The same fit, document by document."""
    patterns = {(1, 1, 0): 70, (1, -1, 1): 5, (-1, -1, -1): 15, (0, 0, 0): 4, (-1, 1, -1): 6}
    rows = [v for v, n in sorted(patterns.items()) for _ in range(n)]
    share, good, bad, _ = fitted_by_row(rows, 3)
    got = Q.expectation_maximisation(patterns, 3)
    for x, y in zip([got[0], *got[1], *got[2]], [share, *good, *bad], strict=True):
        assert math.isclose(x, y, rel_tol=1e-6)


def test_op8_verdict_by_brute_force(spark, sf_docs):
    got = {r["doc_id"]: r for r in op8_weak_supervision(spark, SF).collect()}
    want = kept_by_hand([t for _, t in sf_docs], Q.FUNCTION_WORDS)
    for (doc, _), (p, kept) in zip(sf_docs, want, strict=True):
        assert math.isclose(got[doc]["quality_probability"], p, rel_tol=1e-5, abs_tol=1e-9)
        assert got[doc]["kept"] == kept
    assert 0 < sum(kept for _, kept in want) < len(want)


def test_op8_edge_cases(spark):
    df = crowded(frame(spark))
    rows = Q.judge_documents(df).collect()
    assert len(rows) == len(sample_rows()) and rows[0]["Extra"] == "clash"
    for r in rows:
        assert r["n_words"] == rule_counts(r["text"])[0]
        if not (r["text"] or "").strip():
            assert r["base_failed"] and not r["kept"]
    assert Q.judge_documents(df.limit(0)).count() == 0


def test_op6_on_held_out_rows(spark):
    known = labels(BIG)
    rows = op6_rule_ensemble(spark, BIG).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [(r["predicted"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert len(held) > 50
    for label in (0, 1):
        own = [p == label for p, y in held if y == label]
        assert sum(own) / len(own) > 0.9


def features_by_hand(text):
    text = text or ""
    found = words(text)
    n, chars, symbols, dup_lines, repeats = rule_counts(text)
    if not n:
        return dict.fromkeys(M.FEATURES, 0.0)
    lines = sum(bool(words(x)) for x in text.split("\n"))
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]
    ascii_letters, upper = len(re.findall("[A-Za-z]", text)), len(re.findall("[A-Z]", text))
    size = len(text.encode())
    beyond = sum(len(c.encode()) for c in text if ord(c) > 127)
    return {"log_words": math.log(n + 1), "mean_word": chars / n, "symbols": symbols / n,
            "bare_words": sum(w in set("|-*#<>&=") for w in found) / n,
            "duplicate_lines": dup_lines / max(lines, 1), "repeated_words": repeats / n,
            "capitals": upper / max(ascii_letters, 1),
            "function_words": sum(w.encode() in Q.FUNCTION_WORDS for w in lower) / n,
            "words_per_line": n / max(lines, 1), "distinct_words": len(set(found)) / n,
            "letters": (ascii_letters + beyond) / size, "digits": len(re.findall("[0-9]", text)) / size,
            "end_marks": text.count(".") / n, "shouts": text.count("!") / n}


def test_op6_scores_by_brute_force(spark):
    """Statistics and scores again in plain Python, from the fitted rules."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text")
    truth = spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", M.F.col("quality").alias("label"))
    measured = M.with_features(docs)
    model = M.fit(measured, truth, trees=8)
    assert model.rules and all(w for w, _ in model.rules)
    for r in measured.withColumn("score", model.score()).collect():
        x = features_by_hand(r["text"])
        assert all(math.isclose(a, x[f], rel_tol=1e-12) for f, a in zip(M.FEATURES, r["__x"], strict=True))
        total = model.intercept
        for w, rule in model.rules:
            total += w * all(x[f] <= t if op == "<=" else x[f] > t for f, op, t in rule.terms)
        for w, f, low, high in model.linear:
            total += w * (min(max(x[f], low), high) - low) / (high - low)
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_op6_does_not_depend_on_row_order(spark):
    """Repeated ids with other texts and labels: one fit, whatever the order."""
    texts = ["good words in a line of text " * (3 + i % 4) if i % 2 else "# * | bad & <x> 1 2 3 " * (2 + i % 5)
             for i in range(60)]
    rows = [(i % 40, t, "", "", 0) for i, t in enumerate(texts)]
    marks = [(i % 40, i % 2 if i < 40 else 1) for i in range(60)]
    got = []
    for order in (1, -1):
        docs = M.with_features(frame(spark, rows[::order]).repartition(3 + order))
        model = M.fit(docs, spark.createDataFrame(marks[::order], "doc_id long, label int"), trees=3)
        got.append(model)
    assert got[0] == got[1]


def test_op6_edge_cases(spark):
    df = crowded(frame(spark))
    truth = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(0, 1), (None, 1), (3, None)],
                                  "doc_id long, label int")
    rows = M.score_quality(df, truth, trees=3).collect()
    assert len(rows) == len(sample_rows()) and rows[0]["Extra"] == "clash"
    by_text = {}
    for r, (_, text, *_) in zip(sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"])),
                                sorted(sample_rows(), key=lambda r: (r[0] is None, r[0])), strict=True):
        if r["doc_id"] is not None:
            assert by_text.setdefault(text, r["score"]) == r["score"]
    assert M.score_quality(df.limit(0), truth).count() == 0
    flat = M.score_quality(df, truth.where("label = 1")).collect()
    assert len({r["score"] for r in flat}) == 1 and flat[0]["predicted"] == 1
    none = M.score_quality(df, truth.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_path_rules_are_conjunctions():
    terms = M._shortest([("a", "<=", 3.0), ("a", "<=", 2.0), ("b", ">", 1.0), ("a", ">", 0.5)])
    assert terms == (("a", "<=", 2.0), ("a", ">", 0.5), ("b", ">", 1.0))
