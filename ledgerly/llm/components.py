"""Connected components of a large edge list by alternating star steps.

Every step is a grouped minimum (combined before the shuffle) and a join that
Spark may split where one vertex has very many edges. Nothing but two figures
per round (edge count and a checksum) comes to the driver. Each round is a
table in the shared scratch folder, so the lineage stays short and a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(a, root)`` for every vertex but the roots; the root
    is the smallest vertex of a component. Loops and repeated edges are fine."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                              F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select("a", F.col("b").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("__m"))
    return (both.join(least.select("a", F.least("a", "__m").alias("__m")), "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("__m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("__m"))
    moved = edges.join(least, "a").where("b <> __m").select(F.col("b").alias("a"),
                                                           F.col("__m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("__m", "b")).distinct()


def _state(edges: DataFrame) -> tuple:
    # Narrow sums: the checksum of a set of edges does not depend on their order.
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)
