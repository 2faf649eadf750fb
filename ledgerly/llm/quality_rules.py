"""Quality rules under weak supervision.

Each rule looks at a few counts of a text and votes ``1`` (good), ``-1`` (bad)
or ``0`` (abstains). How far each rule can be trusted is not given: it is
estimated by expectation-maximisation on the votes of all documents. The two
classes have a share, and each rule has two accuracies, one for good and one
for bad documents (the chance that its vote is right when it votes). The
posterior probability of being good replaces all-must-pass filtering.

The votes of a document are one of at most 3^rules patterns, so the fit needs
only the number of documents per pattern: one aggregation, whose size depends
on the rules and not on the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.common import aside, put_back, flatten, stored, without

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
LETTERS = UPPER + bytes(range(0x61, 0x7B))

# Frequent function words of English, French, Spanish, German.
FUNCTION_WORDS = frozenset(w.encode() for w in """
a an and are as at be by for from has have he in is it of on or she that the
this to was were which will with you
au aux avec ce ces dans de des du elle en est et il la le les leur mais ne
nous ou par pas pour qu que qui sa se ses son sur un une vous
al como con del el ella ellos es esta las lo los más no o para pero por su sus
una y
als auch auf aus bei das dass dem den der die ein eine einen er es für hat im
ist mit nach nicht sich sie sind über und von vor war wie wird zu zum zur
""".split())

STATS = ("n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
         "n_repeat_words long, n_upper long, n_letters long, n_function_words long, "
         "n_bare_words long")
STAT_NAMES = [s.split()[0] for s in STATS.split(", ")]


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        if seen[w] > 1:
            hit[i:i + width] = b"\1" * width
    return sum(hit)


def statistics(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode()
    words = raw.split()  # ASCII white space only, as the rules count words
    spaces = len(raw) - len(raw.translate(None, SPACE))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    plain = raw.lower().split()
    return (len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(words),
            len(raw) - len(raw.translate(None, UPPER)),
            len(raw) - len(raw.translate(None, LETTERS)),
            sum(map(FUNCTION_WORDS.__contains__, plain)),
            sum(w in (b"|", b"-", b"*", b"#", b"<", b">", b"&", b"=") for w in words))


def rule_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the counts the rules look at. Map-only."""

    @pandas_udf(STATS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([statistics(t) for t in texts], columns=STAT_NAMES, dtype="int64")

    base = without(docs, *set(STAT_NAMES) - {text})
    return flatten(base.withColumn("__stats", count(F.col(f"`{text}`"))), "__stats")


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))


@dataclass(frozen=True)
class Rule:
    """Good up to ``good``, bad from ``bad`` on, else (and on a null value) no
    vote; with ``good > bad`` the other way round."""

    name: str
    value: Column
    good: float
    bad: float

    def vote(self) -> Column:
        v = self.value
        up = self.good > self.bad
        good = v >= self.good if up else v <= self.good
        bad = v <= self.bad if up else v >= self.bad
        return F.when(good, 1).when(bad, -1).otherwise(0)


def default_rules() -> list[Rule]:
    return [
        Rule("length", F.col("n_words"), 60, 20),
        Rule("symbols", _share("n_symbols", "n_words"), 0.05, 0.25),
        Rule("bare_words", _share("n_bare_words", "n_words"), 0.02, 0.2),
        Rule("duplicate_lines", _share("n_dup_lines", "n_lines"), 0.1, 0.3),
        Rule("repeated_words", _share("n_repeat_words", "n_words"), 0.1, 0.3),
        Rule("word_length", F.abs(_share("word_chars", "n_words") - 6.0), 3.0, 5.0),
        Rule("capitals", _share("n_upper", "n_letters"), 0.15, 0.4),
        Rule("function_words", _share("n_function_words", "n_words"), 0.12, 0.04),
    ]


@dataclass(frozen=True)
class LabelModel:
    rules: list[Rule]
    good_share: float
    right_if_good: list[float]
    right_if_bad: list[float]

    def posterior(self) -> Column:
        """Probability that a document is good, from its rule counts."""
        odds = math.log(self.good_share / (1 - self.good_share))
        total = F.lit(odds)
        for r, g, b in zip(self.rules, self.right_if_good, self.right_if_bad, strict=True):
            vote = r.vote()
            total = total + (F.when(vote == 1, math.log(g / (1 - b)))
                             .when(vote == -1, math.log((1 - g) / b)).otherwise(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def expectation_maximisation(patterns: dict[tuple[int, ...], int], n_rules: int,
                             rounds: int = 200) -> tuple[float, list[float], list[float]]:
    """Class share and accuracies from the number of documents per vote
    pattern. Starts from trusted rules; a few pseudo-documents keep every
    accuracy off 0 and 1. Patterns are taken in sorted order, so equal counts
    give equal figures."""
    share, good, bad = 0.8, [0.8] * n_rules, [0.6] * n_rules
    rows = sorted(patterns.items())
    total = sum(patterns.values())
    for _ in range(rounds):
        n_good, hits_g, votes_g = 0.0, [0.0] * n_rules, [0.0] * n_rules
        hits_b, votes_b = [0.0] * n_rules, [0.0] * n_rules
        for votes, n in rows:
            odds = math.log(share / (1 - share))
            for r, v in enumerate(votes):
                if v:
                    odds += math.log(good[r] / (1 - bad[r]) if v > 0 else (1 - good[r]) / bad[r])
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            n_good += n * p
            for r, v in enumerate(votes):
                if v:
                    votes_g[r] += n * p
                    votes_b[r] += n * (1 - p)
                    hits_g[r] += n * p * (v > 0)
                    hits_b[r] += n * (1 - p) * (v < 0)
        new = ((n_good + 4) / (total + 5),
               [(h + 8) / (v + 10) for h, v in zip(hits_g, votes_g, strict=True)],
               [(h + 3) / (v + 5) for h, v in zip(hits_b, votes_b, strict=True)])
        moved = abs(new[0] - share) + sum(map(abs, (x - y for x, y in zip(
            new[1] + new[2], good + bad, strict=True))))
        share, good, bad = new
        if moved < 1e-9:
            break
    return share, good, bad


def fit_label_model(stats: DataFrame, rules: list[Rule] | None = None) -> LabelModel:
    """Fit on the votes of all rows of ``stats`` (see ``rule_statistics``).

    Collects one row per vote pattern: at most 3^rules, whatever the corpus."""
    rules = default_rules() if rules is None else rules
    names = [f"__v{i}" for i in range(len(rules))]
    counted = (stats.select(*[r.vote().alias(n) for r, n in zip(rules, names, strict=True)])
               .groupBy(*names).count().collect())
    patterns = {tuple(row[n] for n in names): row["count"] for row in counted}
    return LabelModel(rules, *expectation_maximisation(patterns, len(rules)))


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    """Hard base rules: too short, or too much of it repeats."""
    return ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")))


def judge(stats: DataFrame, model: LabelModel, threshold: float = 0.5) -> DataFrame:
    """``stats`` plus ``base_failed``, ``quality_probability`` and ``kept``
    (passes the base and has a posterior of at least ``threshold``).

    A null or empty text has no words and fails the base. Repeated rows are
    judged alike; an empty table gives an empty result."""
    base = without(stats, "base_failed", "quality_probability", "kept")
    return (base.withColumn("base_failed", base_failed())
            .withColumn("quality_probability", model.posterior())
            .withColumn("kept", ~F.col("base_failed")
                        & (F.col("quality_probability") >= threshold)))


def stored_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts of all rows, without the texts, as a stored table: taken once
    where both the fit and the verdict need them and the texts are not."""
    return stored(rule_statistics(docs, text).drop(text), "rule-statistics")


def judge_documents(docs: DataFrame, text: str = "text", threshold: float = 0.5,
                    rules: list[Rule] | None = None) -> DataFrame:
    """Fit on all of ``docs`` and judge each row. Two map-only passes over the
    text (the counts are cheaper to take again than to shuffle texts)."""
    stats = rule_statistics(docs, text)
    return judge(stats, fit_label_model(stats, rules), threshold)


def keep_documents(docs: DataFrame, text: str = "text", threshold: float = 0.5,
                   rules: list[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged, whatever their columns
    are called. Texts are counted once: the rows are stored with their counts."""
    stats = stored(rule_statistics(aside(docs, text), text).drop(text), "quality-rows")
    return put_back(judge(stats, fit_label_model(stats, rules), threshold).where("kept"), docs)
