"""Batch sinks: contract-checked full refresh, table publish, CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerly.contracts import conform


#: Of the stored layers: ids are hex text, which snappy leaves at full length.
COMPRESSION = "zstd"


def full_refresh(df: DataFrame, contract: StructType, path: str) -> str:
    """Project ``df`` onto ``contract`` (names and order, ``try_cast`` types)
    and overwrite the parquet table at ``path``. Returns ``path``."""
    conform(df, contract).write.mode("overwrite").parquet(path, compression=COMPRESSION)
    return path


def create_table(spark: SparkSession, name: str, contract: StructType,
                 path: str | None = None) -> str:
    """Drop the table if it exists and make an empty Parquet table with the
    contract's columns (external where ``path`` is given)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.fields)
    place = f" location '{path}'" if path else ""
    spark.sql(f"drop table if exists {name}")
    spark.sql(f"create table {name} ({columns}) using parquet{place}")
    return name


def publish(df: DataFrame, target: str, mode: str = "overwrite",
            as_table: bool = False, path: str | None = None) -> str:
    """Write ``df`` as a catalog table (``as_table``; external when ``path`` is
    given, so the data lives on shared storage rather than the warehouse
    folder) or as a parquet path."""
    w = df.write.mode(mode)
    if as_table:
        if path:
            w = w.option("path", path)
        w.saveAsTable(target)
    else:
        w.parquet(target)
    return target


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
               single_file: bool = False, encoding: str | None = None) -> str:
    """Delimited-text export. ``single_file`` funnels every row through one
    task and is meant only for small interface files."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite").option("header", header).option("sep", sep)
    if encoding:
        w = w.option("encoding", encoding)
    w.csv(path)
    return path
