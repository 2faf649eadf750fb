"""Joins of a large side that may hold a third of its rows under one key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerly.functions.common import column
from ledgerly.session import scratch_path
from ledgerly.sinks import COMPRESSION

#: A key is hot from this share of the large side's rows on, so at most
#: ``1 / HOT_SHARE`` keys are hot: the bound of what the driver gets and sends.
HOT_SHARE = 1 / 256
#: Parts into which a hot key's rows are dealt.
SALTS = 64


def hot_keys(large: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """The key values (nulls included) that hold over ``share`` of the rows, as a
    local frame of at most ``1 / share`` rows. One job over the key columns
    alone: counts by key, combined before their shuffle, which add up to the rows."""
    seen = Observation()
    counted = (large.groupBy(*map(column, keys)).agg(F.count("*").alias("__n"))
               .observe(seen, F.sum("__n").alias("rows")))
    top = counted.orderBy(F.col("__n").desc()).limit(int(1 / share))
    found = top.collect()
    least = (seen.get["rows"] or 0) * share
    schema = top.schema
    hot = [r[:-1] for r in found if r[-1] > least]
    return large.sparkSession.createDataFrame(hot, StructType(schema.fields[:-1]))


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], spread_by: list[str],
                how: str = "inner", share: float = HOT_SHARE, salts: int = SALTS) -> DataFrame:
    """``large`` joined with ``small`` on the equally named ``keys`` by shuffle.

    The rows of a measured hot key are dealt to ``salts`` parts by the hash of
    the ``spread_by`` columns, and the other side's rows of that key are copied
    once per part; all other rows meet as in a plain join. ``how`` is inner,
    left, left_semi or left_anti. Null keys meet nothing, as ever, but are
    spread if they are many. ``large`` is stored, as it is read twice: a chain of
    such joins computes and shuffles every link once."""
    path = scratch_path(large.sparkSession, "salted")
    large.write.mode("overwrite").parquet(path, compression=COMPRESSION)
    large = large.sparkSession.read.schema(large.schema).parquet(path)
    hot = hot_keys(large, keys, share).toDF(*[f"__k{i}" for i in range(len(keys))])
    hot = F.broadcast(hot.withColumn("__hot", F.lit(True)))

    def marked(side: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [column(k).eqNullSafe(F.col(f"__k{i}"))
                                           for i, k in enumerate(keys)])
        return side.join(hot, same, "left").drop(*[f"__k{i}" for i in range(len(keys))])

    dealt = F.pmod(F.xxhash64(*map(column, spread_by)), F.lit(salts)).cast("int")
    left = marked(large).withColumn("__salt", F.when(F.col("__hot"), dealt).otherwise(0)).drop("__hot")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = marked(small).withColumn("__salt", F.explode(copies)).drop("__hot")
    # A merge join holds neither side's partition in memory.
    return left.join(right.hint("merge"), [*keys, "__salt"], how).drop("__salt")
