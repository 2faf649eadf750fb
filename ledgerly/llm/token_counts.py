"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol per byte, linked in order. A heap holds the rank
and place of every adjacent pair that some merge names; the lowest rank (ties:
leftmost) is popped and merged until none is left. Each merge removes exactly
one symbol, so the count is initial symbols minus merges, and no identifier is
ever emitted. A word of n bytes costs O(n log n), so a text without a single
space is safe. Words repeat: each Python worker keeps a bounded cache of the
counts of short words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.common import without
from ledgerly.llm.vocabulary import ID_BITS, Recent, Vocabulary, load

#: Words kept in one generation of a worker's cache.
CACHE_WORDS = 1 << 18
PLACE_BITS = 40


def merges_of(word: bytes, vocab: Vocabulary) -> int:
    """Number of merges byte-pair encoding makes in one word."""
    first, n = vocab.byte_pair_rank, len(word)
    # A heap entry is a rank and the place of the pair's left symbol. It still
    # holds if the pair now at that place has the same rank: ranks name pairs.
    heap = [r << PLACE_BITS | i for i in range(n - 1)
            if (r := first[word[i] << 8 | word[i + 1]]) is not None]
    if not heap:
        return 0
    heapify(heap)
    rank, merged, byte_id = vocab.rank.get, vocab.merged, vocab.byte_id
    sym = [byte_id[b] for b in word]
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    done = 0
    while heap:
        entry = heappop(heap)
        i = entry & (1 << PLACE_BITS) - 1
        j = after[i]
        if j >= n or sym[i] < 0 or rank(sym[i] << ID_BITS | sym[j]) != entry >> PLACE_BITS:
            continue  # one side was merged meanwhile
        new = sym[i] = merged[entry >> PLACE_BITS]
        sym[j] = -1
        done += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := rank(new << ID_BITS | sym[k])) is not None:
                heappush(heap, r << PLACE_BITS | i)
        h = before[i]
        if h >= 0 and (r := rank(sym[h] << ID_BITS | new)) is not None:
            heappush(heap, r << PLACE_BITS | h)
    return done


class Counter:
    """Counts the tokens of texts, with a bounded cache of words."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.count = Recent(self._count, CACHE_WORDS)

    def _count(self, word: str) -> int:
        if word in self.vocab.special:
            return 1
        raw = word.encode()
        return len(raw) - merges_of(raw, self.vocab)

    def text(self, text: str | None) -> int:
        return sum(map(self.count.__getitem__, self.vocab.words(text))) if text else 0


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(load(path))


def token_count(text: Column | str, vocabulary: str) -> Column:
    """Tokens of a text under a byte-level BPE file; null counts as empty."""

    @pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(vocabulary)
        for texts in batches:
            yield pd.Series([c.text(t) for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text",
                 limit: int = 512) -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (more than ``limit`` tokens). Null and empty texts have 0 bytes and 0
    tokens; rows are neither dropped nor merged, so ties and repeated rows
    keep their own counts. Map-only: no shuffle."""
    base = without(docs, *{"n_bytes", "n_tokens", "over_limit"} - {text})
    t = F.col(f"`{text}`")
    return (base.withColumn("n_bytes", F.coalesce(F.octet_length(t), F.lit(0)).cast("long"))
            .withColumn("n_tokens", token_count(t, vocabulary))
            .withColumn("over_limit", F.col("n_tokens") > limit))
