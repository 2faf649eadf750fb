"""Quality classifier: a sparse rule ensemble.

Statistics of each text feed a small forest; every path from a root to a node
becomes a conjunctive rule over the statistics ("symbols <= a and words > b").
A logistic model with a lasso penalty weighs the rules (and the statistics
themselves, scaled), most of which get no weight; the rest are compiled into
one Spark column expression. Scoring therefore runs without any model object.

Fitting uses at most ``fit_rows`` labelled rows, those with the smallest hash of
their id (a documented, deterministic sample); statistics and scores cover all
rows and whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.common import stored, without
from ledgerly.llm.quality_rules import statistics

FEATURES = ["log_words", "mean_word", "symbols", "bare_words", "duplicate_lines", "repeated_words",
            "capitals", "function_words", "words_per_line", "distinct_words", "letters", "digits",
            "end_marks", "shouts"]


def features(text: str | None) -> tuple[float, ...]:
    """Shares and means of one text; an empty text has zeros."""
    (n, chars, symbols, lines, dup_lines, repeats, upper, letters, function_words,
     bare) = statistics(text)
    if not n:
        return (0.0,) * len(FEATURES)
    raw = (text or "").encode()
    words = raw.split()
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    plain = len(raw) - len(raw.translate(None, bytes(range(0x80, 0x100))))
    return (math.log1p(n), chars / n, symbols / n, bare / n, dup_lines / max(lines, 1), repeats / n,
            upper / max(letters, 1), function_words / n, n / max(lines, 1), len(set(words)) / n,
            (letters + plain) / len(raw), digits / len(raw), raw.count(b".") / n, raw.count(b"!") / n)


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``__x``, an array of the statistics. Map-only."""

    @pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts], dtype="object")

    return docs.withColumn("__x", measure(F.col(f"`{text}`")))


def _value(name: str) -> Column:
    return F.col("__x")[FEATURES.index(name)]


@dataclass(frozen=True)
class PathRule:
    """A conjunction of (statistic, "<=" or ">", threshold)."""

    terms: tuple[tuple[str, str, float], ...]

    def holds(self) -> Column:
        parts = [_value(n) <= x if op == "<=" else _value(n) > x for n, op, x in self.terms]
        return reduce(lambda a, b: a & b, parts)


def path_rules(forest) -> list[PathRule]:
    """All root-to-node paths of a forest, read from the trees' printed form."""
    out: dict[tuple, PathRule] = {}
    line = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)")
    for tree in forest.trees:
        path: list[tuple[int, tuple[str, str, float]]] = []
        for text in tree.toDebugString.split("\n"):
            m = line.match(text)
            if not m:
                continue
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (FEATURES[int(m[3])], m[4], float(m[5]))))
            terms = _shortest([t for _, t in path])
            out.setdefault(terms, PathRule(terms))
    return [out[k] for k in sorted(out)]


def _shortest(terms: list[tuple[str, str, float]]) -> tuple[tuple[str, str, float], ...]:
    """One bound per statistic and direction, in fixed order."""
    best: dict[tuple[str, str], float] = {}
    for n, op, x in terms:
        old = best.get((n, op))
        best[n, op] = x if old is None else min(old, x) if op == "<=" else max(old, x)
    return tuple((n, op, x) for (n, op), x in sorted(best.items()))


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules and scaled statistics; unweighted ones are left out."""

    intercept: float
    rules: list[tuple[float, PathRule]]
    linear: list[tuple[float, str, float, float]]  # weight, statistic, low, high

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for w, rule in self.rules:
            total = total + F.when(rule.holds(), w).otherwise(0.0)
        for w, name, low, high in self.linear:
            total = total + w * _clipped(name, low, high)
        return 1.0 / (1.0 + F.exp(-total))


def _clipped(name: str, low: float, high: float) -> Column:
    return (F.least(F.greatest(_value(name), F.lit(low)), F.lit(high)) - low) / (high - low)


def fit(measured: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000, trees: int = 30,
        depth: int = 3, penalty: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """Fit on rows of ``labels`` (``doc_id``, ``label`` 0 or 1; rows with a null
    are left out, of a repeated id the least label and the least statistics stay)
    that ``measured`` has statistics for. Labels of one class only, or none at all, give a constant score: the
    share of ones, or 0.5."""
    wanted = (labels.where("doc_id is not null and label is not null")
              .groupBy("doc_id").agg(F.min("label").cast("double").alias("label")))
    known = measured.where("doc_id is not null").select("doc_id", "__x").join(wanted, "doc_id")
    one = known.groupBy("doc_id").agg(F.min("__x").alias("__x"), F.min("label").alias("label"))
    rows = stored(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "labelled")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        share = (ones + 0.5) / (n + 1)
        return RuleEnsemble(math.log(share / (1 - share)), [], [])
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        rows.select("label", *[_value(f).alias(f) for f in FEATURES]).coalesce(4)).cache()
    try:
        weight = F.when(F.col("label") == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones)))
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64,
                                        weightCol="w", minInstancesPerNode=5).fit(
            table.select("label", "features", weight.alias("w")))
    finally:
        table.unpersist()
    rules = path_rules(forest)
    bounds = rows.select(*[F.percentile(_value(f), [0.025, 0.975]).alias(f) for f in FEATURES]).first()
    linear = [(f, *bounds[f]) for f in FEATURES if bounds[f][1] > bounds[f][0]]
    inputs = [r.holds().cast("double") for r in rules] + [_clipped(*x) for x in linear]
    named = rows.select("label", *[c.alias(f"f{i}") for i, c in enumerate(inputs)]).coalesce(4)
    vectors = VectorAssembler(inputCols=named.columns[1:], outputCol="features").transform(named)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False,
                               maxIter=100).fit(vectors.select("label", "features"))
    weights = [float(w) for w in lasso.coefficients.toArray()]
    return RuleEnsemble(float(lasso.intercept),
                        [(w, r) for w, r in zip(weights, rules, strict=False) if w],
                        [(w, *x) for w, x in zip(weights[len(rules):], linear, strict=True) if w])


def score_quality(docs: DataFrame, labels: DataFrame, *, text: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the texts, plus ``score`` (0 to 1, higher: label 1
    likelier) and ``predicted`` (1 from 0.5 on). ``docs`` needs ``doc_id``.

    Null and empty texts have zero statistics and a score like any other row;
    equal texts have equal scores, whatever their id. An empty table gives an
    empty result."""
    measured = stored(with_features(without(docs, *{"score", "predicted"} - {text, "doc_id"}), text)
                      .drop(text), "statistics")
    model = fit(measured, labels, **options)
    scored = measured.withColumn("score", model.score())
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop("__x")
