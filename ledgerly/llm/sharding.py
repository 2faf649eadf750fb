"""Sharding by histogram sort: near-equal bytes per shard, one exchange.

Rows are ordered by a 128-bit key: the hash of the group (equal texts are one
group) and, inside a group, the hash of the row's identity. Splitters start as
wide key intervals. Each round counts the exact bytes below a few thousand
probe keys inside the intervals that still straddle a target, over all
partitions, and narrows every interval to the probes around its target, until
the bytes below a splitter are within tolerance of the target or one key is
left. A large group is therefore cut by the second half of the key, and only
where a splitter needs it; other groups stay whole. Where one key alone (repeated
rows) holds more than the tolerance, the splitter is that key and a number of its
rows: as they have one text, a count is a number of bytes.

Only then do the rows move, once: to cells of a shard's key range that hold
similar numbers of rows, in which they are numbered. The rows of a key that is cut
by count (at most one key per splitter) are dealt to as many cells as there are
shuffle partitions, numbered and stored there, and take their shard from their
number. Everything is DataFrame expressions; what comes to the driver is bounded
by the number of probes and shards.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerly.llm.common import stored, without

HALF = 64
#: log2 of the probes counted per straddling interval and round.
PROBE_BITS = 11
#: Rows of a numbering cell at which more cells are made, and the most cells
#: (log2): their first slots are broadcast, some 24 bytes a cell.
CELL_ROWS, MOST_CELL_BITS = 1 << 17, 20


@dataclass
class _Interval:
    """Keys [low, high) around one splitter; ``below`` bytes lie under ``low``
    and ``inside`` bytes of ``rows`` rows in it."""

    target: float
    low: int
    high: int
    below: int
    inside: int
    rows: int


def _signed(x: int) -> int:
    """An unsigned 64-bit value in the order of Spark's signed longs."""
    return x - (1 << 63)


def _at_least(key: int) -> Column:
    """(__h, __g) >= key, for a 128-bit key."""
    h, g = _signed(key >> HALF), _signed(key & (1 << HALF) - 1)
    return (F.col("__h") > h) | ((F.col("__h") == h) & (F.col("__g") >= g))


def _probe(interval: _Interval) -> tuple[Column, int]:
    """The probe cell of a row inside the interval, and the cell's width in keys.
    Intervals are powers of two wide and aligned, so a cell is some bits of one
    half of the key."""
    bits = (interval.high - interval.low).bit_length() - 1
    step = max(0, bits - PROBE_BITS)
    if bits > HALF:
        step = max(step, HALF)  # finish the first half before using the second
    half, shift = ("__h", step - HALF) if step >= HALF else ("__g", step)
    mask = (1 << min(bits, PROBE_BITS, bits - step)) - 1
    # Flip the sign bit back, so that the bits are those of the unsigned half.
    raw = F.col(half).bitwiseXOR(F.lit(-(1 << 63)))
    return F.shiftrightunsigned(raw, shift).bitwiseAND(F.lit(mask)), step


def find_splitters(keys: DataFrame, shards: int, tolerance: float = 0.001
                   ) -> tuple[list[tuple[int, int]], dict[int, int], int]:
    """Splitters, the rows of the keys cut by count, and the number of rounds, for
    a frame with ``__h``, ``__g`` and ``size``. A splitter is a 128-bit key and a
    number n: shard i ends before the key's row n. ``tolerance`` is a share of a
    shard's bytes."""
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    whole = 1 << 2 * HALF
    open_ = [_Interval(total * (i + 1) / shards, 0, whole, 0, total, rows) for i in range(shards - 1)]
    allowed, rounds, done, cut = tolerance * total / shards, 0, {}, {}
    names = list(range(shards - 1))
    while open_:
        left_names, left = [], []
        for i, x in zip(names, open_, strict=True):
            if x.high - x.low > 1 and x.rows > 1 and x.inside > allowed:
                left_names.append(i)
                left.append(x)
            elif x.high - x.low == 1 and x.rows > 1 and x.inside > allowed:  # a number of its rows
                n = round((x.target - x.below) * x.rows / x.inside)
                done[i], cut[x.low] = (x.low, n), x.rows
            else:  # the nearer end
                near = x.low if x.target - x.below <= x.below + x.inside - x.target else x.high
                done[i] = near, 0
        if not left:
            break
        rounds += 1
        ranges: dict[tuple[int, int], list[int]] = {}
        for k, x in enumerate(left):
            ranges.setdefault((x.low, x.high), []).append(k)
        which, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
        widths = []
        for j, ((low, high), members) in enumerate(ranges.items()):
            inside = _at_least(low) & ~_at_least(high) if high < whole else _at_least(low)
            probe, step = _probe(left[members[0]])
            which, cell = F.when(inside, j).otherwise(which), F.when(inside, probe).otherwise(cell)
            widths.append(step)
        counted = (keys.select(which.alias("w"), cell.alias("c"), "size", "__h", "__g").where("w is not null")
                   .groupBy("w", "c").agg(F.sum("size").alias("b"), F.count("*").alias("n"),
                                          F.min("__h").alias("h0"), F.max("__h").alias("h1"),
                                          F.min("__g").alias("g0"), F.max("__g").alias("g1"))
                   .collect())
        cells: dict[int, list] = {}
        for r in counted:
            cells.setdefault(r["w"], []).append(r)
        for j, ((low, _), members) in enumerate(ranges.items()):
            for k in members:
                x, below, width = left[k], left[k].below, 1 << widths[j]
                for r in sorted(cells[j], key=lambda r: r["c"]):
                    if below + r["b"] >= x.target:
                        x.low, x.high = low + r["c"] * width, low + (r["c"] + 1) * width
                        x.below, x.inside, x.rows = below, r["b"], r["n"]
                        if r["h0"] == r["h1"] and width > 1 << HALF:  # one group: go to its rows
                            x.low = (r["h0"] + (1 << 63)) << HALF
                            x.high = x.low + (1 << HALF)
                        if r["h0"] == r["h1"] and r["g0"] == r["g1"]:  # one key
                            x.low = ((r["h0"] + (1 << 63)) << HALF) + r["g0"] + (1 << 63)
                            x.high = x.low + 1
                        break
                    below += r["b"]
        names, open_ = left_names, left
    return [done[i] for i in range(shards - 1)], cut, rounds


def _shard_of(splitters: list[tuple[int, int]]) -> Column:
    """Shard of a row whose key is not cut by count."""
    past = [F.when(_at_least(s), 1).otherwise(0) if s < 1 << 2 * HALF else F.lit(0) for s, _ in splitters]
    return reduce(lambda a, b: a + b, past, F.lit(0)).cast("int")


def _is_key(key: int) -> Column:
    h, g = _signed(key >> HALF), _signed(key & (1 << HALF) - 1)
    return (F.col("__h") == h) & (F.col("__g") == g)


def _cut_key(cut: dict[int, int]) -> Column:
    """Which of the keys that are cut by count a row has; null: none."""
    which = F.lit(None).cast("int")
    for i, key in enumerate(sorted(cut)):
        which = F.when(_is_key(key), i).otherwise(which)
    return which


def shard_documents(docs: DataFrame, shards: int = 8, *, text: str = "text",
                    doc_id: str = "doc_id", tolerance: float = 0.001) -> DataFrame:
    """``docs`` plus ``size`` (UTF-8 bytes of the text plus one; null: 1),
    ``shard`` (0 to ``shards`` - 1, near-equal bytes) and ``slot`` (gapless from
    0 in each shard).

    Groups are equal texts; null texts are one group, empty texts another. Rows
    that agree in text and ``doc_id`` have one key: they stay together unless a
    splitter needs some of them, and their slots follow in no particular order,
    as the rows cannot be told apart. A single row larger than a shard's share
    makes its shard that much larger. An empty table gives an empty result."""
    t = F.col(f"`{text}`")
    keyed = without(docs, *{"size", "shard", "slot"} - {text, doc_id}).withColumns({
        "__h": F.xxhash64(t),
        "__g": F.xxhash64(F.col(f"`{doc_id}`"), F.lit(1)),
        "size": (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long")})
    keys = stored(keyed.select("__h", "__g", "size"), "shard-keys")
    splitters, cut, _ = find_splitters(keys, shards, tolerance)
    out = [c for c in docs.columns if c.lower() not in {"size", "shard", "slot"} - {text, doc_id}]
    out = [F.col(f"`{c}`") for c in out] + ["size", "shard", "slot"]
    of_cut = _cut_key(cut)
    special, shard = keyed.withColumn("__k", of_cut).where("__k is not null"), _shard_of(splitters)
    if cut:
        keys, keyed = keys.where(of_cut.isNull()), keyed.where(of_cut.isNull())
    bits, heavy = _cells(keys)
    sizes = (_celled(keys, bits, heavy).withColumn("shard", shard).groupBy("shard", "__cell")
             .agg(F.count("*").alias("n")))
    before = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "__cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    order = Window.partitionBy("shard", "__cell").orderBy("__h", "__g", F.col(f"`{doc_id}`"))
    numbered = (_celled(keyed, bits, heavy).withColumn("shard", shard).repartition("shard", "__cell")
                .withColumn("__n", F.row_number().over(order) - 1)
                .join(F.broadcast(offsets), ["shard", "__cell"])
                .withColumn("slot", F.col("__start") + F.col("__n"))).select(*out)
    if not cut:
        return numbered
    filled = dict(sizes.groupBy("shard").agg(F.sum("n")).collect())
    return numbered.unionByName(_cut_by_count(special, splitters, cut, filled).select(*out))


def _cut_by_count(rows: DataFrame, splitters: list[tuple[int, int]], cut: dict[int, int],
                  filled: dict[int, int]) -> DataFrame:
    """Shard and slot of the rows of the keys that are cut by count (``__k``).
    ``filled`` is the number of slots that the other rows take in each shard."""
    spark = rows.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    inside = Window.partitionBy("__k", "__salt").orderBy("__h")
    # Stored: which copy has which number may not change once it is counted.
    numbered = stored(dealt.repartition("__k", "__salt")
                      .withColumn("__n", F.row_number().over(inside) - 1), "shard-copies")
    before = Window.partitionBy("__k").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy("__k", "__salt").agg(F.count("*").alias("n")).select(
        "__k", "__salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    ranges, filled = [], dict(filled)
    for k, key in enumerate(sorted(cut)):
        first = sum(s < key for s, _ in splitters)
        edges = [0, *sorted(n for s, n in splitters if s == key), cut[key]]
        for j, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
            ranges.append((k, low, high, first + j, filled.get(first + j, 0)))
            filled[first + j] = filled.get(first + j, 0) + high - low
    ranges = spark.createDataFrame(ranges, "__k int, __low long, __high long, shard int, __base long")
    ranked = numbered.join(F.broadcast(starts), ["__k", "__salt"]).withColumn(
        "__rank", F.col("__start") + F.col("__n"))
    return (ranked.join(F.broadcast(ranges), "__k")
            .where((F.col("__rank") >= F.col("__low")) & (F.col("__rank") < F.col("__high")))
            .withColumn("slot", F.col("__base") + F.col("__rank") - F.col("__low")))


def _raw_cell(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("__h").bitwiseXOR(F.lit(-(1 << 63))), HALF - bits)


def _cells(keys: DataFrame) -> tuple[int, DataFrame]:
    """Number of leading bits of the group hash that make a cell, and the heavy
    cells: those with far more rows than the mean (a large group), which are
    split by the row hash into ``__ways``. There are enough cells for the rows
    and the shuffle partitions, up to ``MOST_CELL_BITS``."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keys.count()
    bits = max(4, min(MOST_CELL_BITS, max(4 * parts, rows // CELL_ROWS).bit_length()))
    mean = max(1.0, rows / (1 << bits))
    counts = keys.groupBy(_raw_cell(bits).alias("__raw")).count().where(F.col("count") > 4 * mean)
    ways = F.least(F.lit(1 << bits), F.floor(F.col("count") / mean)).cast("long")
    return bits, stored(counts.select("__raw", ways.alias("__ways")), "shard-cells")


def _celled(rows: DataFrame, bits: int, heavy: DataFrame) -> DataFrame:
    """``rows`` plus ``__cell``. At most a quarter of all cells are heavy, so the
    broadcast is bounded as the cells are."""
    marked = rows.withColumn("__raw", _raw_cell(bits)).join(F.broadcast(heavy), "__raw", "left")
    way = F.coalesce(F.pmod(F.col("__g"), F.col("__ways")), F.lit(0).cast("long"))
    return marked.withColumn("__cell", F.col("__raw") * (1 << bits) + way).drop("__raw", "__ways")
