"""Shared helpers of the training-data operators.

Conventions that hold for every operator of this subpackage:

* a null text is a text without words (or bytes, where sizes are counted);
* an input column that has the name of an output column is replaced by it;
  names that start with two underscores are the operators' own;
* other extra columns pass through, whatever they are called;
* an empty table gives an empty result with the full schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.session import ensure_checkpoint_dir, scratch_path

__all__ = ["aside", "documents", "ensure_checkpoint_dir", "flatten", "put_back", "scratch_path",
           "stored", "without"]


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns an operator is about to write (case-insensitive, as
    Spark resolves names)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def flatten(df: DataFrame, struct: str) -> DataFrame:
    """Replace a struct column by its fields."""
    fields = [f.name for f in df.schema[struct].dataType.fields]
    kept = [F.col(f"`{c}`") for c in df.columns if c != struct]
    return df.select(*kept, *[F.col(f"`{struct}`").getField(f).alias(f) for f in fields])


def aside(docs: DataFrame, *needed: str) -> DataFrame:
    """The ``needed`` columns alone, and the whole row as one column: an operator
    may then write any column name without replacing one of the input's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row_in"),
                       *[F.col(f"`{c}`") for c in needed])


def put_back(found: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``docs`` as they came, but for the ``replaced`` ones."""
    return found.select(*[replaced[c].alias(c) if c in replaced else F.col("__row_in").getField(c).alias(c)
                          for c in docs.columns])


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: cuts the
    lineage, survives lost executors and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
