"""Stratified case sampling: at most ``n`` rows from every combination of
dimension predicates, in one pass.

Each row gets the index of the predicate it satisfies in every dimension (or
every index, when predicates overlap); the case id is the tuple of indices.
``row_number() <= n`` over the case lets Spark insert a partial per-partition
group limit before the shuffle, so even a case holding a third of all rows
ships at most ``n`` rows per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CASE_COLUMN = "CASE_ID"


def _first_index(preds: Sequence[Column]) -> Column:
    expr = None
    for i, p in enumerate(preds):
        expr = F.when(p, F.lit(i)) if expr is None else expr.when(p, F.lit(i))
    return expr


def _all_indices(preds: Sequence[Column]) -> Column:
    arr = F.array(*[F.when(p, F.lit(i)) for i, p in enumerate(preds)])
    return F.filter(arr, lambda x: x.isNotNull())


def case_ids(df: DataFrame, dims: Sequence[Sequence[Column]],
             overlapping: bool = False, name: str = CASE_COLUMN) -> DataFrame:
    """Add ``name`` = ``'i-j-k'`` (predicate index per dimension); rows outside
    every case of some dimension are dropped. With ``overlapping`` a row is
    repeated once per case it belongs to."""
    idx_cols = []
    for d, preds in enumerate(dims):
        c = f"_CASE_{d}"
        if overlapping:
            df = df.withColumn(c, F.explode(_all_indices(preds)))
        else:
            df = df.withColumn(c, _first_index(preds)).filter(F.col(c).isNotNull())
        idx_cols.append(c)
    df = df.withColumn(name, F.concat_ws("-", *[F.col(c).cast("string") for c in idx_cols]))
    return df.drop(*idx_cols)


def case_sample(df: DataFrame, dims: Sequence[Sequence[Column]], n: int,
                order_by: Sequence[str | Column], overlapping: bool = False,
                name: str = CASE_COLUMN) -> DataFrame:
    """At most ``n`` rows per case, the first ``n`` by ``order_by``."""
    labelled = case_ids(df, dims, overlapping, name)
    w = Window.partitionBy(name).orderBy(*order_by)
    return (labelled.withColumn("_RN", F.row_number().over(w))
            .filter(F.col("_RN") <= n).drop("_RN"))
