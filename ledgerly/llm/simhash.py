"""SimHash near-duplicates with BK-trees.

Every text becomes a 64-bit fingerprint; fingerprints within ``max_bits``
differing bits are linked, and a group of near-duplicates is a connected
component. Equal fingerprints are grouped first, so a group of exact copies
costs one fingerprint, however large it is.

Links between different fingerprints are found in BK-trees: a node's children
are keyed by their integer Hamming distance to it, and a search follows only
the edges whose key is within the radius of the distance to the node. The
trees are sharded by agreement: with the 64 bits cut into ``max_bits + k``
blocks, two fingerprints within ``max_bits`` agree in at least ``k`` whole
blocks. Each choice of ``k`` blocks is a table, each value of these blocks (or
of some of their bits) is a shard with its own tree, and a fingerprint searches
exactly the shards that can hold a neighbour. The bits of a shard's key follow
the counted number of fingerprints, so that a tree holds about ``tree_size`` of
them whatever the size of the corpus. Shards that hold over ``max_tree`` go on:
their members are dealt again by the tables of more blocks, and at the last
level a shard holds at most 2^13 (for two bits).

The trees grow with the corpus, and a Spark broadcast goes through the driver,
so they are not broadcast: a tree and the fingerprints that search it meet in
one shuffle of 8-byte fingerprints. A task answers with a spanning forest of
what it linked, never with all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.bpe_trie import chunks
from ledgerly.llm.common import stored, without
from ledgerly.llm.components import connected_components
from ledgerly.operators.skew import salted_join

SEED = 42
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingles(text: str | None, width: int) -> list[bytes]:
    """Word shingles of the lower-cased (A-Z) text, repeats included; fewer
    words than ``width`` are one shingle, no words none."""
    words = (text or "").encode().translate(LOWER).split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def fingerprints(texts: list[str | None], width: int) -> np.ndarray:
    """Bits set in over half the shingles' XXH64 values; 0 without shingles."""
    digest = xxhash.xxh64_intdigest
    values, counts = [], []
    for t in texts:
        own = [digest(s, SEED) for s in shingles(t, width)]
        values += own
        counts.append(len(own))
    out = np.zeros(len(texts), np.uint64)
    n = np.array(counts, np.int64)
    full = np.flatnonzero(n)
    if len(full):
        h = np.array(values, np.uint64)
        starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
        for bit in range(64):
            ones = np.add.reduceat((h >> np.uint64(bit)) & np.uint64(1), starts)
            out[full] |= (2 * ones.astype(np.int64) > n[full]).astype(np.uint64) << np.uint64(bit)
    return out.view(np.int64)


def fingerprint_documents(docs: DataFrame, *, shingle_words: int = 3, text: str = "text",
                          out: str = "simhash") -> DataFrame:
    """``docs`` plus the fingerprint as a signed 64-bit integer. Map-only."""

    @pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for part in chunks(texts):
                yield pd.Series(fingerprints(part, shingle_words))

    return without(docs, *{out} - {text}).withColumn(out, fingerprint(F.col(f"`{text}`")))


class BKTree:
    """Distinct integers; a child hangs at its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while new:
            d = (self.values[at] ^ value).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = new
                break
            at = self.children[at][d]
        return new

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` bits away."""
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            kids = self.children[at]
            if kids:
                stack += [kids[k] for k in range(d - radius, d + radius + 1) if k in kids]
        return found


def linked_in_shard(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links in one shard: (member, smallest member of
    its component)."""
    if len(values) == 2:
        a, b = sorted(values)
        return [(b, a)] if (a ^ b).bit_count() <= radius else []
    tree, parent = BKTree(), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for v in sorted(values):  # so the first of a component is its smallest
        near = {root(x) for x in tree.within(v, radius)}
        new = tree.add(v)
        parent.append(new)
        if near:
            least = min(near)
            for r in (*near, new):
                parent[r] = least
    return [(v, tree.values[r]) for i, v in enumerate(tree.values) if (r := root(i)) != i]


def shard_masks(radius: int, agree: int = 4, width: int = 64) -> list[int]:
    """One mask per choice of ``agree`` whole blocks of ``radius + agree``; the
    blocks are as equal in width as 64 bits allow. A mask of more than ``width``
    bits keeps ``width`` of them: what agrees in all agrees in some."""
    n = radius + agree
    edges = [round(64 * i / n) for i in range(n + 1)]
    masks = []
    for pick in combinations(range(n), agree):
        bits = [b for i in pick for b in range(edges[i], edges[i + 1])]
        masks.append(sum(1 << b for b in bits[:width]))
    return masks


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def deal(rows: DataFrame, masks: list[int]) -> DataFrame:
    """``rows`` (``simhash``, and ``table`` and ``shard`` of the level before)
    once per mask. A shard's value holds the bits of all masks that led to it."""
    shard = F.explode(F.array(*[
        F.struct((F.col("table") * len(masks) + i).alias("table"),
                 F.col("shard").bitwiseOR(F.col("simhash").bitwiseAND(F.lit(signed(m)))).alias("shard"))
        for i, m in enumerate(masks)]))
    return rows.select("simhash", shard.alias("s")).select("simhash", "s.*")


def sharded(distinct: DataFrame, *, max_bits: int = 2, tree_size: int = 64,
            max_tree: int = 4096) -> DataFrame:
    """``(simhash, table, shard)``: every two fingerprints within ``max_bits``
    meet in some shard. Only the numbers of rows and of oversized shards come to
    the driver; the shards of a level are counted by a sum before the shuffle."""
    count = distinct.count()
    width = max(0, math.ceil(math.log2(max(1, count / tree_size))))
    agree = next((k for k in (1, 2) if 64 * k // (max_bits + k) >= width), 2)
    levels = [shard_masks(max_bits, agree, width), shard_masks(max_bits), shard_masks(max_bits, 8)]
    rows = distinct.select("simhash", F.lit(0).cast("long").alias("table"),
                           F.lit(0).cast("long").alias("shard"))
    done = []
    for level, masks in enumerate(levels):
        rows = deal(rows, masks)
        if level + 1 == len(levels):
            break
        large = stored(rows.groupBy("table", "shard").agg(F.count("*").alias("n"))
                       .where(F.col("n") > max_tree).select("table", "shard"), "large-shards")
        if not large.count():
            break
        done.append(rows.join(large, ["table", "shard"], "left_anti").select("simhash", "table", "shard"))
        rows = rows.join(large, ["table", "shard"], "left_semi").select("simhash", "table", "shard")
        # tables of the next level follow all of this one's, so no two levels share a table
        rows = rows.withColumn("table", F.col("table") + F.lit(len(masks)))
    return reduce(DataFrame.unionByName, [*done, rows])


def fingerprint_links(distinct: DataFrame, *, max_bits: int = 2, tree_size: int = 64,
                      max_tree: int = 4096) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of distinct
    fingerprints (column ``simhash``) within ``max_bits`` bits."""
    dealt = (sharded(distinct, max_bits=max_bits, tree_size=tree_size, max_tree=max_tree)
             .repartition("table", "shard").sortWithinPartitions("table", "shard", "simhash"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = pd.DataFrame()  # the last shard of a batch may go on in the next
        for batch in batches:
            rows = pd.concat([tail, batch], ignore_index=True)
            keys = rows[["table", "shard"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(cuts):
                yield _links(rows["simhash"].to_numpy()[:cuts[-1]], [0, *cuts])
            tail = rows.iloc[cuts[-1] if len(cuts) else 0:]
        if len(tail):
            yield _links(tail["simhash"].to_numpy(), [0, len(tail)])

    def _links(values: np.ndarray, edges: list[int]) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        unsigned = values.view(np.uint64)
        edges = np.array(edges)
        for i in np.flatnonzero(np.diff(edges) > 1):
            out += linked_in_shard(unsigned[edges[i]:edges[i + 1]].tolist(), max_bits)
        both = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    return dealt.mapInPandas(search, "a long, b long")


def fingerprint_groups(marked: DataFrame, *, max_bits: int = 2) -> DataFrame:
    """Components of a frame with ``simhash`` and ``doc_id``: one row per
    distinct fingerprint with ``group`` (smallest fingerprint of the component)
    and ``component_id`` (smallest doc_id; null if no member has one)."""
    distinct = stored(marked.groupBy("simhash").agg(F.min("doc_id").alias("__doc")), "simhash")
    roots = connected_components(fingerprint_links(distinct, max_bits=max_bits))
    grouped = (distinct.join(roots.withColumnRenamed("a", "simhash"), "simhash", "left")
               .select("simhash", "__doc", F.coalesce("root", "simhash").alias("group")))
    least = grouped.groupBy("group").agg(F.min("__doc").alias("component_id"))
    return grouped.drop("__doc").join(least, "group")


def near_duplicates(docs: DataFrame, *, shingle_words: int = 3, max_bits: int = 2,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``text_key`` (64-bit hash of the text),
    ``simhash``, ``group`` and ``component_id`` (smallest doc_id reachable).

    Texts without words (null and empty ones) have fingerprint 0 and link like
    any other. Rows without a doc_id belong to groups but never name one.
    Repeated rows come back as often as they came in."""
    marked = stored(fingerprint_documents(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("__text")),
        shingle_words=shingle_words, text="__text")
        .select("doc_id", F.xxhash64("__text").alias("text_key"), "simhash"), "fingerprints")
    groups = fingerprint_groups(marked, max_bits=max_bits)
    return salted_join(marked, groups, ["simhash"], ["doc_id", "text_key"]).select(
        "doc_id", "text_key", "simhash", "group", "component_id")


def drop_near_duplicates(docs: DataFrame, *, shingle_words: int = 3, max_bits: int = 2,
                         text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document per group: the one with the smallest doc_id
    (one without a doc_id only if no member has one; ties: smallest hash of the
    text). Of repeated rows one stays. Texts are shuffled once, by document."""
    found = near_duplicates(docs, shingle_words=shingle_words, max_bits=max_bits, text=text,
                            doc_id=doc_id)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("f")
    keep = found.groupBy("group").agg(first).select(
        F.coalesce(F.col("f.doc_id").cast("string"), F.lit("")).alias("__id"),
        F.col("f.text_key").alias("__key"))
    keyed = docs.withColumns({"__id": F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")),
                              "__key": F.xxhash64(F.col(f"`{text}`"))})
    return (keyed.join(keep, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"])
            .drop("__id", "__key"))
