"""Vector code compression: product codes found by equal-average search.

A vector is cut into parts; each part is replaced by the index of the nearest
entry of that part's codebook. The codebooks are refined by rounds of "assign
every part, replace every entry by the mean of its parts", all in integers, so
the result does not depend on how the rows are spread over tasks.

The nearest entry is found by equal-average search: a codebook is sorted by
component sum, and the search walks outward from the part's own sum, a few entries
on either side in turn. Two points of dimension k whose sums differ by g are at
least g*g/k apart (squared), so the walk ends on a side once that strictly exceeds
the best distance: strictly, because an entry at the same distance with a lower
index still wins.

A task sends at most one partial sum per codebook component; the driver gets the
sums of the codebooks (entries x dimension figures) and never a vector beyond
the first ``entries`` ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.common import flatten, stored, without

#: Integer components per unit of the input.
SCALE = 1024
#: Bits of one summand of a large sum; sums of such limbs fit a long over 2^23 tasks.
LIMB = 40
#: Parts of like sums that walk together, and entries looked at in one step.
WALK_ROWS, WALK_ENTRIES = 256, 16
#: Labels whose error sums are broadcast at most; beyond, they are joined by shuffle.
MOST_LABELS = 1_000_000


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of each component: longs, or Python integers where a
    component is too large for exact long arithmetic."""
    wide = vectors.astype(np.float64)
    if wide.size and np.abs(wide).max() >= 2.0**52:
        # from 2^52 on, a double is an integer
        whole = [int(x) * SCALE if abs(x) >= 2.0**52 else math.floor(x * SCALE)
                 for x in wide.ravel().tolist()]
        out = np.empty(len(whole), dtype=object)
        out[:] = whole
        return out.reshape(wide.shape)
    return np.floor(wide * SCALE).astype(np.int64)


def _long_is_enough(*arrays: np.ndarray) -> bool:
    """Squares and their sums stay below 2^62."""
    if any(a.dtype == object for a in arrays):
        return False
    width = arrays[0].shape[1]
    return all(not a.size or int(np.abs(a).max()) * width < 1 << 30 for a in arrays)


def _double_is_exact(*arrays: np.ndarray) -> bool:
    """Squares and their sums stay below 2^53."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return 4 * arrays[0].shape[1] * most * most < 1 << 53


class Codebook:
    """One part's entries, sorted by component sum for the search."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(axis=1)
        self.order = np.array(sorted(range(len(entries)), key=lambda i: (sums[i], i)), dtype=np.int64)
        self.sums = sums[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance, per row of ``parts``;
        ties go to the lower index."""
        if _long_is_enough(parts, self.entries):
            return self._nearest_long(parts)
        found = [self._nearest_one(list(map(int, p))) for p in parts]
        return (np.array([i for i, _ in found], dtype=np.int64),
                np.array([d for _, d in found], dtype=object))

    def _nearest_long(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of like sums walk outward together, a few entries at a time; rows
        whose own walk has ended on a side are not compared there any more."""
        index = np.full(len(parts), len(self.entries))
        best = np.full(len(parts), np.iinfo(np.int64).max)
        sums = parts.sum(axis=1)
        by_sum = np.argsort(sums, kind="stable")
        ordered = self.entries[self.order]
        if _double_is_exact(parts, ordered):    # the same integers, multiplied faster
            parts, ordered = parts.astype(np.float64), ordered.astype(np.float64)
        squares = (ordered * ordered).sum(axis=1)
        for at in range(0, len(parts), WALK_ROWS):
            rows = by_sum[at:at + WALK_ROWS]
            index[rows], best[rows] = self._walk(parts[rows], sums[rows], ordered, squares)
        return index, best

    def _walk(self, x: np.ndarray, own: np.ndarray, ordered: np.ndarray,
              squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, width, most = len(ordered), x.shape[1], np.iinfo(np.int64).max
        index, best = np.full(len(x), n), np.full(len(x), most)
        own_squares = (x * x).sum(axis=1)
        left = right = int(np.searchsorted(self.sums, own[len(own) // 2]))
        going_left, going_right = left > 0, right < n
        while going_left or going_right:
            for side in ("left", "right"):
                if side == "left" and going_left:
                    gap = np.maximum(own - self.sums[left - 1], 0)
                    looked = slice(max(left - WALK_ENTRIES, 0), left)
                elif side == "right" and going_right:
                    gap = np.maximum(self.sums[right] - own, 0)
                    looked = slice(right, min(right + WALK_ENTRIES, n))
                else:
                    continue
                # gap * gap / width > best ends a row's walk on this side
                rows = np.flatnonzero(gap * gap <= np.minimum(best, most // width) * width)
                if not len(rows):
                    going_left, going_right = going_left and side != "left", going_right and side != "right"
                    continue
                distance = (own_squares[rows, None] + squares[looked]
                            - 2 * (x[rows] @ ordered[looked].T)).astype(np.int64)
                near = distance.min(axis=1)
                entry = np.where(distance == near[:, None], self.order[looked], n).min(axis=1)
                wins = (near < best[rows]) | (near == best[rows]) & (entry < index[rows])
                best[rows[wins]], index[rows[wins]] = near[wins], entry[wins]
                if side == "left":
                    left, going_left = looked.start, looked.start > 0
                else:
                    right, going_right = looked.stop, looked.stop < n
        return index, best

    def _nearest_one(self, part: list[int]) -> tuple[int, int]:
        """As ``_nearest_long`` for one part, in integers of any size."""
        n, own = len(self.order), sum(part)
        sums = [int(s) for s in self.sums]
        right = int(sum(s < own for s in sums))
        left, best = right - 1, None
        while left >= 0 or right < n:
            if left < 0 or right < n and sums[right] - own <= own - sums[left]:
                at, right = right, right + 1
            else:
                at, left = left, left - 1
            if best is not None and (sums[at] - own) ** 2 > best[0] * len(part):
                break
            entry = int(self.order[at])
            distance = sum((a - int(b)) ** 2 for a, b in zip(part, self.entries[entry], strict=True))
            if best is None or (distance, entry) < best:
                best = (distance, entry)
        return best[1], best[0]


def cut(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(vectors, parts, axis=1)


def finite(vector: str):
    """The vector is there and every component is a finite number."""
    bad = F.exists(f"`{vector}`", lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x) == F.lit(float("inf"))))
    return F.col(f"`{vector}`").isNotNull() & ~F.coalesce(bad, F.lit(False))


def fit_codebooks(vectors: DataFrame, id_col: str, vector: str, parts: int, entries: int,
                  rounds: int) -> list[np.ndarray] | None:
    """Codebooks (one array of entries per part) of the vectors whose length is
    that of the vector with the smallest id; None where there is no vector.
    Every round is one pass with partial sums per task."""
    fit = vectors.where((F.size(f"`{vector}`") > 0) & (F.size(f"`{vector}`") % parts == 0))
    start = (fit.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").alias("v"))
             .orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect())
    if not start:
        return None
    dim = len(start[0]["v"])
    width = dim // parts
    books = cut(scaled(np.array([r["v"] for r in start if len(r["v"]) == dim])), parts)
    rows = fit.where(F.size(f"`{vector}`") == dim).select(F.col(f"`{vector}`").alias("v"))
    for _ in range(rounds):
        totals: dict[tuple[int, int], int] = {}
        for r in _summed(rows, books, dim).collect():
            key = (r["slot"], r["place"])
            totals[key] = totals.get(key, 0) + (r["value"] << LIMB * r["limb"])
        books = [_moved(book, {e: [totals.get((p * entries + e, i), 0) for i in range(width + 1)]
                               for e in range(len(book))}) for p, book in enumerate(books)]
    return books


def _moved(book: np.ndarray, sums: dict[int, list[int]]) -> np.ndarray:
    """Entries replaced by the floored means of their parts; the last figure of
    ``sums`` is the count. Unused entries stay."""
    new = [[s // total[-1] for s in total[:-1]] if total[-1] else [int(x) for x in book[e]]
           for e, total in sums.items()]
    out = np.empty((len(book), book.shape[1]), dtype=object)
    out[:] = new
    small = all(abs(x) < 1 << 62 for row in new for x in row)
    return out.astype(np.int64) if small else out


def _summed(rows: DataFrame, books: list[np.ndarray], dim: int) -> DataFrame:
    """``(slot, place, limb, value)``: sums of the parts by their nearest entry.
    A sum is sent as limbs of 40 bits, so that no total overflows."""
    parts, entries, width = len(books), max(len(books[0]), 1), dim // len(books)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = [Codebook(b) for b in books]
        sums = [np.zeros((entries, width + 1), dtype=object) for _ in books]
        for batch in batches:
            column = batch.column(0)
            wide = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
            for p, part in enumerate(cut(scaled(wide), parts)):
                index, _ = searchers[p].nearest(part)
                if part.dtype != object and _long_is_enough(part):
                    added = np.zeros((entries, width + 1), dtype=np.int64)
                else:
                    added = np.zeros((entries, width + 1), dtype=object)
                np.add.at(added, (index, slice(0, width)), part)
                np.add.at(added, (index, width), 1)
                sums[p] = sums[p] + added
        slot, place, limb, value = [], [], [], []
        for p in range(parts):
            for e in np.flatnonzero(sums[p][:, width] != 0).tolist():
                for i, total in enumerate(map(int, sums[p][e])):
                    at = 0
                    # the last limb keeps the sign
                    while True:
                        last = -(1 << LIMB) <= total < 1 << LIMB
                        slot.append(p * entries + e)
                        place.append(i)
                        limb.append(at)
                        value.append(total if last else total & (1 << LIMB) - 1)
                        if last:
                            break
                        total >>= LIMB
                        at += 1
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(slot, pa.int32()), "place": pa.array(place, pa.int32()),
            "limb": pa.array(limb, pa.int32()), "value": pa.array(value, pa.int64())})

    return (rows.mapInArrow(partial, "slot int, place int, limb int, value long")
            .groupBy("slot", "place", "limb").agg(F.sum("value").alias("value")))


def codebooks_sha256(books: list[np.ndarray] | None) -> str:
    """Digest of all entries' components by part, entry and position."""
    line = ",".join(str(int(x)) for book in books or [] for entry in book for x in entry)
    return hashlib.sha256(line.encode()).hexdigest()


def encode_vectors(vectors: DataFrame, books: list[np.ndarray] | None, vector: str) -> DataFrame:
    """``vectors`` plus ``code`` and ``error``; null where the vector's length is
    not that of the codebooks, and an error too large for a long is null."""
    dim = sum(b.shape[1] for b in books) if books else 0

    @pandas_udf("code string, error long")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        searchers = [Codebook(b) for b in books or []]
        for batch in batches:
            out = pd.DataFrame({"code": pd.Series([None] * len(batch), dtype="object"),
                                "error": pd.Series([None] * len(batch), dtype="Int64")})
            fit = [i for i, v in enumerate(batch) if dim and v is not None and len(v) == dim]
            if fit:
                wide = scaled(np.stack([np.asarray(batch.iloc[i]) for i in fit]))
                found = [s.nearest(p) for s, p in zip(searchers, cut(wide, len(searchers)),
                                                     strict=True)]
                codes = ["".join(f"{i:02x}" for i in row)
                         for row in zip(*(index.tolist() for index, _ in found), strict=True)]
                errors = [sum(map(int, row))
                          for row in zip(*(d.tolist() for _, d in found), strict=True)]
                out.loc[fit, "code"] = codes
                out["error"] = pd.array(
                    _at(len(batch), fit, [e if e < 1 << 63 else None for e in errors]), dtype="Int64")
            yield out

    return flatten(vectors.withColumn("__coded", encode(F.col(f"`{vector}`"))), "__coded")


def _at(size: int, places: list[int], values: list) -> list:
    out = [None] * size
    for i, v in zip(places, values, strict=True):
        out[i] = v
    return out


def compress_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
                     label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4,
                     most_labels: int = MOST_LABELS) -> DataFrame:
    """Rows with a finite vector, plus ``code``, ``error``, ``label_error`` and
    ``codebooks_sha256``.

    Null vectors and vectors with a null, NaN or infinite component are dropped.
    The codebooks start as the first ``entries`` rows by id (null ids last, equal
    ids by vector; repeated rows count each). Their length is that of the first
    row whose length is a multiple of ``parts``; vectors of any other length stay
    with a null code and error. Fewer than ``entries`` rows give smaller
    codebooks; an empty table an empty result. ``label_error`` sums the errors of
    a label's rows (nulls are one label); a label without any error has null.
    Extra columns pass through; columns named as the outputs are replaced."""
    names = {"code", "error", "label_error", "codebooks_sha256"} - {id_col, vector, label}
    kept = without(df.where(finite(vector)), *names)
    books = fit_codebooks(kept, id_col, vector, parts, entries, rounds)
    coded = stored(encode_vectors(kept, books, vector), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    sums = stored(coded.groupBy(F.col(f"`{label}`").alias("__label")).agg(total), "label-errors")
    if sums.count() <= most_labels:
        sums = F.broadcast(sums)
    # Beyond the bound labels are many; a hot one is split by the skew join.
    return (coded.join(sums, F.col(f"`{label}`").eqNullSafe(F.col("__label")), "left").drop("__label")
            .withColumn("codebooks_sha256", F.lit(codebooks_sha256(books))))
