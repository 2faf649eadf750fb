"""Delimited-text sources: receipt extracts and reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerly.contracts import RAW
from ledgerly.functions import file_prefix


def read_receipts(spark: SparkSession, path: str, schema: StructType = RAW) -> DataFrame:
    """Pipe-delimited receipt extract with a header row.

    The explicit schema names the fields by position; the header text is
    skipped, so extracts whose header spells names differently still load.
    Short rows are NULL-padded, long rows truncated.
    """
    return (spark.read.schema(schema)
            .option("header", True)
            .option("sep", "|")
            .csv(path))


def receipt_field_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per file prefix (``SOURCE``) and number of fields, header lines left
    out: ``read_receipts`` pads short lines and cuts long ones without a word, so
    anything but 27 fields deserves a look. Separators inside quotes are text."""
    outside = r'\|(?=(?:[^"]*"[^"]*")*[^"]*$)'
    value = F.col("value")
    # The pattern looks at the rest of the line at every separator; a line
    # without quotes needs only their number.
    plain = F.length(value) - F.length(F.replace(value, F.lit("|"), F.lit(""))) + 1
    n_fields = F.when(value.contains('"'), F.size(F.split(value, outside, -1))).otherwise(plain)
    lines = spark.read.text(path).withColumn("SOURCE", file_prefix())
    return (lines.where(~value.startswith(RAW.fieldNames()[0] + "|"))
            .groupBy("SOURCE", n_fields.alias("n_fields"))
            .agg(F.count(F.lit(1)).alias("n")))


def read_reference(spark: SparkSession, path: str, sep: str = ",",
                   schema: StructType | None = None,
                   encoding: str | None = None) -> DataFrame:
    """Header-first reference table.

    Without ``schema`` every column is text and named from the header (no
    inference pass over the data). With ``schema`` values are typed on read.
    ``encoding`` covers legacy exports such as ISO-8859-1.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if encoding:
        reader = reader.option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)
