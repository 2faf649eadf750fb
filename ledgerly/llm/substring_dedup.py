"""Substring deduplication with a count-min prefilter.

A window is ``width`` consecutive words of one document. Windows that occur
more than once, anywhere, are found in two passes:

1. *Sketch.* Every task counts its windows in a count-min sketch and the
   sketches are merged by addition (counts saturate at two: only "once" and
   "more" matter). A window is counted through its anchor, the smallest k-word
   hash inside it: equal windows have equal anchors at equal distances, so two
   occurrences of a window are two occurrences of its anchor, at different
   places. The merged sketch never underestimates, so no repeated window is
   lost; and about one place in fifteen is an anchor, so it stays small.
2. *Exact groups.* Only windows whose anchor the sketch estimates at two or
   more are sent on, by hash range, and grouped exactly by a 96-bit hash.
   Occurrences inside one task are settled there, so a window that a third of
   all documents share reaches its group once per task.

The sketch is sized from the counted anchors, so that at most ``LOAD`` of its
cells are taken whatever the input. A corpus that needs more than
``max_sketch_bits`` allows is handled in several ranges of anchor hashes, each
with a sketch and an exact pass of its own: equal windows have equal anchors, so
a range holds all occurrences of its windows.

What comes back are word ranges per document, which join the texts by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.bpe_trie import chunks
from ledgerly.llm.common import flatten, stored, without

#: Words of an anchor, rows of the sketch, cells of one block of a row (log2).
ANCHOR, ROWS, BLOCK_BITS = 8, 2, 18
#: Anchors per cell that a sketch is sized for (at most).
LOAD = 0.25
#: Hash ranges of the second pass per shuffle partition, and the windows that
#: one range (held whole by a task) may have on average.
RANGES_PER_PARTITION, RANGE_WINDOWS = 4, 1 << 20
CHUNK = 2 << 20
#: Settled occurrences that a task gathers before it sends them on.
GATHERED = 1 << 19
_U = np.uint64
_MIX = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at a time, and the longest word that is hashed there.
SPAN, LONG = 1 << 16, 64


def _mixed(x: np.ndarray, lane: int) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _MIX[lane]
    return x ^ (x >> _U(32))


def _powers(base: int) -> np.ndarray:
    return np.multiply.accumulate(np.append(_U(1), np.full(SPAN + LONG, base, _U)))


#: A value for each byte, powers of an odd base, and of its inverse modulo 2^64.
_BYTE = _mixed(_mixed(np.arange(1, 257, dtype=_U) * _MIX[1], 2), 0)
_POWER, _INVERSE = _powers(int(_MIX[0])), _powers(pow(int(_MIX[0]), -1, 1 << 64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of some bytes. Prefix sums of byte
    values times powers give all words of a span at once; long words, which
    such sums hash less well, are hashed one by one."""
    space = np.concatenate([[True], _SPACE[data], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, end = edges[::2], edges[1::2]
    out = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        low = int(start[i])
        j = int(np.searchsorted(start, low + SPAN))
        span = _BYTE[data[low:low + SPAN + LONG]]
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(span * _POWER[:len(span)], dtype=_U)])
        a, b = start[i:j] - low, np.minimum(end[i:j] - low, len(span))
        out[i:j] = (sums[b] - sums[a]) * _INVERSE[a]
        i = j
    out = _mixed(out, 1)
    for k in np.flatnonzero(end - start > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[start[k]:end[k]].tobytes())
    return start, out


def _rolled(h: np.ndarray, width: int, lane: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes, by doubling."""
    power, done, out, span = _MIX[lane], 0, None, h
    size = 1
    while True:
        if width & size:
            if out is None:
                out, done = span, size
            else:  # the part so far, followed by this one
                n = len(h) - done - size + 1
                out = out[:n] * power + span[done:done + n]
                done += size
        if size * 2 > width:
            return _mixed(out, lane)
        n = len(span) - size
        span = span[:n] * power + span[size:size + n]
        power = _U(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
        size *= 2


class Windows:
    """The windows of some texts: places, anchors and hashes."""

    def __init__(self, texts: list[str | None], width: int):
        data = [(t or "").encode() for t in texts]
        starts, self.hashes = word_hashes(np.frombuffer(b"\n".join(data), np.uint8))
        offsets = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
        self.first = np.searchsorted(starts, offsets)
        self.counts, self.width = np.diff(self.first), width
        # Starts of whole windows, and the document of each.
        per_doc = np.maximum(self.counts - width + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), per_doc)
        before = np.concatenate([[0], np.cumsum(per_doc)])
        self.start = np.arange(len(self.doc)) - before[self.doc] + self.first[self.doc]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window its anchor's hash and place. Places break ties, the
        leftmost first, so the choice depends on the window's words alone."""
        if not len(self.start):
            return np.zeros(0, _U), np.zeros(0, np.int64)
        size = min(ANCHOR, self.width)
        gram = _rolled(self.hashes, size, 0)
        low = (gram & ~_U(0xFFFFFFFF)) | np.arange(len(gram), dtype=_U)  # rank, then place
        span, step = self.width - size + 1, 1
        while step * 2 <= span:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        least = np.minimum(low[self.start], low[self.start + span - step])
        place = (least & _U(0xFFFFFFFF)).astype(np.int64)
        return gram[place], place

    def exact(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of hash of the chosen windows: 64 and 32."""
        at = self.start[keep]
        return (_rolled(self.hashes, self.width, 1)[at],
                (_rolled(self.hashes, self.width, 2)[at] >> _U(32)).astype(np.uint32))


def _range_of(gram: np.ndarray, ranges: int) -> np.ndarray:
    """Anchor range, by other bits than the cells'."""
    return (_mixed(gram ^ _MIX[2], 0) >> _U(32)) % _U(ranges)


def count_anchors(texts: DataFrame, width: int) -> tuple[int, int]:
    """Places that are anchors, and windows. ``texts`` has the one column ``text``."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = windows = 0
        for batch in batches:
            for part in chunks(batch["text"], CHUNK):
                _, place = Windows(part, width).anchors()
                places, windows = places + len(np.unique(place)), windows + len(place)
        yield pd.DataFrame({"places": [places], "windows": [windows]})

    r = texts.mapInPandas(count, "places long, windows long").agg(F.sum("places"), F.sum("windows")).first()
    return r[0] or 0, r[1] or 0


def sketch_shape(anchors: int, max_bits: int) -> tuple[int, int]:
    """Bits of a sketch for so many anchors, and the ranges that need one each."""
    cells = max(1 << 10, int(anchors / LOAD))
    bits = min((cells - 1).bit_length(), max_bits)
    return bits, -(-cells // (1 << bits))


def _cells(gram: np.ndarray, row: int, bits: int) -> np.ndarray:
    return _mixed(gram, row + 1) >> _U(64 - bits)


def merged_sketch(texts: DataFrame, width: int, bits: int, ranges: int = 1, chosen: int = 0) -> bytes:
    """Bitmaps (one per row, end to end) of the cells whose merged count is two
    or more, over the anchors of one range. ``texts`` has the one column ``text``."""
    block = min(bits, BLOCK_BITS)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The task's own sketch: cells met once, and cells met more often.
        once = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(ROWS)]
        more = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(ROWS)]
        for batch in batches:
            for part in chunks(batch["text"], CHUNK):
                gram, place = Windows(part, width).anchors()
                _, fresh = np.unique(place, return_index=True)  # an anchor's place counts once
                gram = gram[fresh]
                if ranges > 1:
                    gram = gram[_range_of(gram, ranges) == chosen]
                for r in range(ROWS):
                    cell, n = np.unique(_cells(gram, r, bits), return_counts=True)
                    byte, bit = (cell >> _U(3)).astype(np.int64), np.uint8(1) << (cell & _U(7)).astype(np.uint8)
                    again = (once[r][byte] & bit > 0) | (n > 1)
                    np.bitwise_or.at(more[r], byte[again], bit[again])
                    np.bitwise_or.at(once[r], byte, bit)
        out = []
        for r in range(ROWS):
            for b in range(1 << bits - block):
                part = slice(b << block - 3, (b + 1) << block - 3)
                cells = np.flatnonzero(np.unpackbits(once[r][part], bitorder="little"))
                twice = np.unpackbits(more[r][part], bitorder="little")[cells]
                if len(cells):
                    out.append((r << 32 | b, (cells << 1 | twice).astype("<u4").tobytes()))
        yield pd.DataFrame(out, columns=["block", "cells"])

    def merge(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(1 << block, np.uint8)
        for batch in batches:
            for packed in batch["cells"]:
                x = np.frombuffer(packed, "<u4")
                at = x >> 1
                count[at] = np.minimum(2, count[at] + 1 + (x & 1))
        bitmap = np.packbits(count >= 2, bitorder="little").tobytes()
        yield pd.DataFrame({"block": [key[0]], "bitmap": [bitmap]})

    merged = (texts.mapInPandas(sketch, "block long, cells binary").groupBy("block")
              .applyInPandas(merge, "block long, bitmap binary"))
    whole = bytearray(ROWS << bits - 3)
    for r in merged.toLocalIterator():  # at most the two bitmaps
        at = ((r["block"] >> 32) << bits - 3) + ((r["block"] & 0xFFFFFFFF) << block - 3)
        whole[at:at + len(r["bitmap"])] = r["bitmap"]
    return bytes(whole)


def _estimated_repeated(gram: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(gram), bool)
    for r in range(ROWS):
        cell = _cells(gram, r, bits)
        at = (cell >> _U(3)).astype(np.int64) + (r << bits - 3)
        ok &= bitmap[at] >> (cell & _U(7)).astype(np.uint8) & np.uint8(1) > 0
    return ok


#: Packed occurrences: hash (64 and 32 bits), whether the task saw it again,
#: document id, text hash, and place of the window.
OCCURRENCE = np.dtype([("h", "<u8"), ("g", "<u4"), ("again", "u1"), ("doc", "<i8"), ("key", "<i8"),
                       ("at", "<u4")])
SETTLED = np.dtype([("doc", "<i8"), ("key", "<i8"), ("at", "<u4")])


def repeated_windows(docs: DataFrame, width: int, sketch_bits: int | None,
                     max_sketch_bits: int) -> DataFrame:
    """Starts of repeated windows: ``(__id, __key, starts)``, one row per
    document that has any. ``docs`` has ``__id`` (long), ``__key`` (long) and ``text``."""
    spark = docs.sparkSession
    anchors, windows = count_anchors(docs.select("text"), width)
    bits, passes = (sketch_bits, 1) if sketch_bits else sketch_shape(anchors, max_sketch_bits)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 1 << (max(RANGES_PER_PARTITION * parts, windows // RANGE_WINDOWS) - 1).bit_length()
    parts = max(parts, ranges // (2 * RANGES_PER_PARTITION))
    shift = 64 - (ranges.bit_length() - 1)

    def candidates(batches: Iterator[pd.DataFrame], bitmap, chosen: int) -> Iterator[pd.DataFrame]:
        table = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            at = 0
            for part in chunks(batch["text"], CHUNK):
                ids = batch["__id"].to_numpy()[at:at + len(part)]
                keys = batch["__key"].to_numpy()[at:at + len(part)]
                at += len(part)
                w = Windows(part, width)
                gram, _ = w.anchors()
                maybe = _estimated_repeated(gram, table, bits)
                if passes > 1:
                    maybe &= _range_of(gram, passes) == chosen
                keep = np.flatnonzero(maybe)
                h, g = w.exact(keep)
                yield _packed(h, g, ids[w.doc[keep]], keys[w.doc[keep]],
                              w.start[keep] - w.first[w.doc[keep]])

    def _packed(h, g, ids, keys, at) -> pd.DataFrame:
        order = np.lexsort((g, h))
        h, g, ids, keys, at = (x[order] for x in (h, g, ids, keys, at))
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])[:len(h)]
        size = np.diff(np.append(np.flatnonzero(new), len(h)))
        rows = np.zeros(int(new.sum()), OCCURRENCE)
        for name, x in (("h", h), ("g", g), ("doc", ids), ("key", keys), ("at", at)):
            rows[name] = x[new]
        rows["again"] = size > 1
        # Further occurrences of a window are settled here: it is repeated.
        rest = np.zeros(int((~new).sum()), SETTLED)
        for name, x in (("doc", ids), ("key", keys), ("at", at)):
            rest[name] = x[~new]
        out = [(r, x, b"") for r, x in _split(rows, rows["h"] >> _U(shift))]
        out += [(r, b"", x) for r, x in _split(rest, _document_hash(rest) >> _U(shift))]
        return pd.DataFrame(out, columns=["range", "open", "settled"])

    def group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Settle every hash range, and send the result on by document range."""
        now, held, done = None, [], []

        def sent() -> pd.DataFrame:
            rows = np.concatenate([np.zeros(0, SETTLED), *done])
            done.clear()
            by_doc = rows[np.lexsort((rows["at"], rows["key"], rows["doc"]))]
            parts = _split(by_doc, _document_hash(by_doc) >> _U(shift))
            return pd.DataFrame(parts, columns=["range", "settled"])

        for batch in batches:
            for r, packed, settled in zip(batch["range"], batch["open"], batch["settled"], strict=True):
                if r != now and held:
                    done.append(_repeated(np.concatenate(held)))
                    held = []
                now = r
                if packed:
                    held.append(np.frombuffer(packed, OCCURRENCE))
                if settled:
                    done.append(np.frombuffer(settled, SETTLED))
            if sum(map(len, done)) > GATHERED:
                yield sent()
        if held:
            done.append(_repeated(np.concatenate(held)))
        yield sent()

    def regroup(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row per document."""
        now, held = None, []
        for batch in batches:
            for r, settled in zip(batch["range"], batch["settled"], strict=True):
                if r != now and held:
                    yield _starts(np.concatenate(held))
                    held = []
                now = r
                held.append(np.frombuffer(settled, SETTLED))
        if held:
            yield _starts(np.concatenate(held))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(parts, "range").sortWithinPartitions("range")

    def settled_in(chosen: int) -> DataFrame:
        bitmap = spark.sparkContext.broadcast(
            merged_sketch(docs.select("text"), width, bits, passes, chosen))
        open_ = docs.mapInPandas(lambda b: candidates(b, bitmap, chosen),
                                 "range long, open binary, settled binary")
        settled = dealt(open_).mapInPandas(group, "range long, settled binary")
        if passes > 1:  # one bitmap alive at a time
            settled = stored(settled, "repeated-windows")
            bitmap.unpersist()
        return settled

    settled = settled_in(0)
    for chosen in range(1, passes):
        settled = settled.unionByName(settled_in(chosen))
    return dealt(settled).mapInPandas(regroup, "__id long, __key long, starts binary")


def _document_hash(rows: np.ndarray) -> np.ndarray:
    return _mixed(rows["doc"].astype(_U) * _MIX[1] + rows["key"].astype(_U), 0)


def _split(rows: np.ndarray, ranges: np.ndarray) -> list[tuple[int, bytes]]:
    """The rows of each range, packed."""
    if not len(rows):
        return []
    order = np.argsort(ranges, kind="stable")
    rows, ranges = rows[order], ranges[order].astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(ranges)) + 1), len(rows)]
    return [(int(ranges[i]), rows[i:j].tobytes()) for i, j in zip(edges, edges[1:], strict=False)]


def _repeated(rows: np.ndarray) -> np.ndarray:
    """Where the window of an occurrence occurs elsewhere."""
    order = np.lexsort((rows["g"], rows["h"]))
    rows = rows[order]
    same = (rows["h"][1:] == rows["h"][:-1]) & (rows["g"][1:] == rows["g"][:-1])
    hit = rows["again"].astype(bool)
    hit[1:] |= same
    hit[:-1] |= same
    out = np.zeros(int(hit.sum()), SETTLED)
    for name in SETTLED.names:
        out[name] = rows[name][hit]
    return out


def _starts(rows: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((rows["at"], rows["key"], rows["doc"]))
    rows = rows[order]
    edges = np.flatnonzero((np.diff(rows["doc"]) != 0) | (np.diff(rows["key"]) != 0)) + 1
    parts = np.split(rows, edges) if len(rows) else []
    return pd.DataFrame([(int(x["doc"][0]), int(x["key"][0]), x["at"].astype("<u4").tobytes())
                         for x in parts], columns=["__id", "__key", "starts"])


def _covered(n_words: int, starts: bytes, width: int) -> np.ndarray:
    """Which words lie in a window that starts at one of the packed places."""
    step = np.zeros(n_words + width + 1, np.int32)
    at = np.frombuffer(starts, "<u4")
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    return np.cumsum(step)[:n_words] > 0


def remove_repeats(docs: DataFrame, *, width: int = 35, text: str = "text",
                   doc_id: str = "doc_id", sketch_bits: int | None = None,
                   max_sketch_bits: int = 28) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_removed`` and ``kept_text``: the words
    outside every repeated window, joined by one space.

    A window repeats if its words start anywhere else too, the same document
    included; all its occurrences go. Windows are judged on the input. Words
    are separated by ASCII white space. Null and empty texts and texts shorter
    than a window lose nothing. Repeated rows repeat each other's windows; rows
    that agree in ``doc_id`` and text share one result. Rows without a doc_id
    count like any other. A doc_id must be a long or a text that casts to one.

    The sketch takes as many cells as the counted anchors need, at most
    ``2^max_sketch_bits`` a row (28: a broadcast of 64 MB); beyond that, ranges
    of anchors are taken one after another. ``sketch_bits`` fixes its size."""
    base = without(docs, *{"n_words", "n_removed", "kept_text"} - {text, doc_id})
    t = F.col(f"`{text}`")
    # A row is known by its id and the hash of its text; null ids share -1.
    keyed = base.withColumns({"__id": F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-1)),
                              "__key": F.xxhash64(t)})
    found = repeated_windows(keyed.select("__id", "__key", t.alias("text")), width, sketch_bits,
                             max_sketch_bits)
    marks = found.withColumnRenamed("starts", "__starts")

    @pandas_udf("n_words long, n_removed long, kept_text string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts in batches:
            out = []
            for s, marks in zip(texts, starts, strict=True):
                words = (s or "").encode().split()
                if marks:
                    gone = _covered(len(words), marks, width)
                    kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"])

    joined = keyed.join(marks, ["__id", "__key"], "left")
    out = flatten(joined.withColumn("__cut", cut(t, F.col("__starts"))), "__cut")
    return out.drop("__id", "__key", "__starts")


