"""Row-count controls per layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly.functions.common import column
from ledgerly.operators.changes import row_digest


def layer_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row ``(layer, n)`` per frame; each count is a partial+final
    aggregate, and the union runs as one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def receipt_key_profile(f0: DataFrame, key: str = "COD_RECIBO") -> DataFrame:
    """One row: receipt lines, distinct lines, distinct receipt numbers.

    ``n_distinct_lines > n_receipts`` means some receipt number carries two
    different receipts (their event ids would collide); ``n_lines >
    n_distinct_lines`` counts re-delivered identical lines. The lines are read
    once and told apart by number and 128-bit digest, so no whole row is
    shuffled. Both aggregates combine map-side, so a hot key or a mass duplicate
    is collapsed before the shuffle.
    """
    lines = (f0.withColumns(row_digest(f0.columns)).groupBy(column(key).alias("_KEY"), "_D1", "_D2")
             .agg(F.count(F.lit(1)).alias("_LINES")))
    receipts = lines.groupBy("_KEY").agg(F.sum("_LINES").alias("_LINES"),
                                         F.count(F.lit(1)).alias("_DISTINCT"))
    return receipts.agg(F.coalesce(F.sum("_LINES"), F.lit(0)).cast("long").alias("n_lines"),
                        F.coalesce(F.sum("_DISTINCT"), F.lit(0)).cast("long").alias("n_distinct_lines"),
                        F.count("_KEY").alias("n_receipts"))
