"""Benchmark decontamination against a broadcast set of test n-grams.

Benchmark items are normalised to words and cut into windows (``width`` words;
a shorter item is one window). The distinct windows go to every task as a hash
set. A task turns the words of its documents into ids of the set's own
vocabulary, hashes the windows in which every word is known, and verifies each
hash hit word by word. A document word inside any verified window is hit.

The set is broadcast in blocks: windows are dealt to as many blocks as keep
each under ``block_bytes``. With more than one, the documents are stored with a
row number and scanned once per block; a block's hits are stored and its
broadcast is released before the next one starts, so no process holds two. A
benchmark of any size is therefore handled whole.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.bpe_trie import chunks
from ledgerly.llm.common import aside, flatten, put_back, stored, without

#: Upper-case ASCII to lower case; every other ASCII byte that is neither a
#: digit nor a letter to a space; bytes from 0x80 on stay.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or b >= 0x61 and b != 0x7F
             and not 0x7B <= b <= 0x7E or b >= 0x80 else 32 for b in range(256))
HITS = "n_words long, spans array<struct<start:int,end:int>>, item_ids array<string>"


def normalised_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def benchmark_windows(benchmark: DataFrame, width: int, text: str, item_id: str) -> DataFrame:
    """Distinct ``(window, item_id)``: words joined by one space. Items without
    words have no windows; the windows of items without an id have a null one."""

    @pandas_udf("array<string>")
    def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                w = normalised_words(t)
                out.append([b" ".join(w[i:i + width]).decode()
                            for i in range(max(1, len(w) - width + 1))] if w else [])
            yield pd.Series(out, dtype="object")

    return benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item_id"),
                            F.explode(windows(F.col(f"`{text}`"))).alias("window")).distinct()


class WindowSet:
    """Hash set of windows over its own word vocabulary."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.word_id: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str | None]] = {}
        for window, item in rows:
            ids = tuple(self.word_id.setdefault(w, len(self.word_id) + 1)
                        for w in window.encode().split())
            self.items.setdefault(ids, []).append(item)
        self.widths = sorted({len(w) for w in self.items})
        rng = np.random.default_rng(7)
        self.weights = rng.integers(1, 1 << 63, max(self.widths, default=0), dtype=np.uint64) | 1
        self.hashes = {n: np.unique(np.array([self._hash(np.array([w], np.uint64), n)[0]
                                              for w in self.items if len(w) == n], np.uint64))
                       for n in self.widths}

    def _hash(self, windows: np.ndarray, n: int) -> np.ndarray:
        return (windows * self.weights[:n]).sum(axis=1, dtype=np.uint64)

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, int, list[str | None]]]:
        """Start, width and items of every occurrence in a run of word ids
        (0: a word of no window)."""
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for n in self.widths:
            at = np.flatnonzero(known[n:] - known[:-n] == n) if len(ids) >= n else []
            if len(at):
                h = np.zeros(len(at), np.uint64)
                for k in range(n):
                    h += ids[at + k].astype(np.uint64) * self.weights[k]
                table = self.hashes[n]
                slot = np.minimum(np.searchsorted(table, h), len(table) - 1)
                for i in at[table[slot] == h]:
                    items = self.items.get(tuple(ids[i:i + n].tolist()))
                    if items:
                        yield int(i), n, items


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def scan_texts(texts: list[str | None], windows: WindowSet) -> tuple[list, list, list]:
    """Per text: number of words, hit word spans, and items found."""
    get = windows.word_id.get
    ids, bounds = [], [0]
    for t in texts:
        ids += map(get, normalised_words(t), repeat(0))
        ids.append(0)  # no window crosses from one text to the next
        bounds.append(len(ids))
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    for i, n, found in windows.find(np.array(ids, np.int64)):
        k = bisect_right(bounds, i) - 1
        spans[k].append((i - bounds[k], i - bounds[k] + n))
        items[k].update(x for x in found if x is not None)
    return [bounds[k + 1] - bounds[k] - 1 for k in range(len(texts))], spans, items


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, width: int = 10,
                       text: str = "text", benchmark_text: str = "text",
                       item_id: str = "item_id", block_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` plus ``n_words``, ``spans`` (hit word ranges, end exclusive),
    ``item_ids`` (sorted as strings) and ``n_hit``.

    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing; items with equal texts are all named. The words of an item without
    an id hit like any other's, but it adds nothing to ``item_ids``. Documents are never
    shuffled: ties and repeated rows are scanned where they are."""
    spark = docs.sparkSession
    base = without(docs, *{"n_words", "spans", "item_ids", "n_hit"} - {text})
    windows = benchmark_windows(benchmark, width, benchmark_text, item_id)
    total = windows.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 64)).first()[0]
    blocks = max(1, -(-2 * (total or 0) // block_bytes))  # dealt by hash: leave room for chance
    if blocks == 1:
        scan = _scan_udf(spark.sparkContext.broadcast(_window_set(windows)))
        out = flatten(base.withColumn("__hits", scan(F.col(f"`{text}`"))), "__hits")
    else:
        out = _scanned_by_block(base, windows, blocks, text)
    return out.withColumn("n_hit", F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]))


def _scan_udf(shared: Broadcast):
    @pandas_udf(HITS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            for part in chunks(texts):
                n, spans, items = scan_texts(part, shared.value)
                yield pd.DataFrame({
                    "n_words": n, "item_ids": [sorted(p) for p in items],
                    "spans": [[{"start": x, "end": y} for x, y in merge_spans(p)] for p in spans]})

    return scan


def _window_set(windows: DataFrame) -> WindowSet:
    return WindowSet([(r["window"], r["item_id"]) for r in
                      windows.select("window", "item_id").orderBy("window", "item_id").collect()])


def _scanned_by_block(docs: DataFrame, windows: DataFrame, blocks: int, text: str) -> DataFrame:
    """The documents with the joined hits of all blocks, one block at a time."""
    spark = docs.sparkSession
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "decontamination-docs")
    dealt = stored(windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks))),
                   "decontamination-windows")
    hits = None
    for b in range(blocks):
        shared = spark.sparkContext.broadcast(_window_set(dealt.where(F.col("block") == b)))
        scan = _scan_udf(shared)
        found = flatten(numbered.select("__row", scan(F.col(f"`{text}`")).alias("__hits")), "__hits")
        if b:  # the first block's rows bring every document's n_words
            found = found.where(F.size("spans") > 0)
        part = stored(found, f"decontamination-hits-{b}")
        shared.destroy()
        hits = part if hits is None else hits.unionByName(part)

    @pandas_udf("array<struct<start:int,end:int>>")
    def join_spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([[{"start": s, "end": e} for s, e in merge_spans(
                [(x["start"], x["end"]) for x in r])] for r in rows], dtype="object")

    joined = hits.groupBy("__row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    joined = joined.select("__row", "n_words", join_spans("spans").alias("spans"), "item_ids")
    return numbered.join(joined, "__row").drop("__row")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, mode: str = "document",
                         text: str = "text", **options) -> DataFrame:
    """``docs`` without what the benchmark hits: whole documents
    (``mode="document"``) or only the hit word spans (``mode="span"``; the text
    between two words goes with the words on both sides of it). Clean documents
    come back unchanged."""
    found = find_contamination(aside(docs, text), benchmark, text=text, **options)
    if mode == "document":
        return put_back(found.where(F.col("n_hit") == 0), docs)
    if mode != "span":
        raise ValueError(f"unknown mode {mode!r}")

    @pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            yield pd.Series([cut_words(t, [(x["start"], x["end"]) for x in s])
                             for t, s in zip(texts, spans, strict=True)], dtype="object")

    clean = F.when(F.col("n_hit") > 0, cut(F.col(f"`{text}`"), F.col("spans"))).otherwise(F.col(f"`{text}`"))
    return put_back(found, docs, **{text: clean})


def cut_words(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the given word ranges."""
    if not spans or text is None:
        return text
    raw = text.encode()
    word = np.frombuffer(raw.translate(FOLD), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], word.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:starts[s]])
        at = ends[e - 1]
    return b"".join([*out, raw[at:]]).decode()
