"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the driver tables (or data
Spark derives from them), so its work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SUM_TYPE = "decimal(18,2)"


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


def count_sql(src: str, *keys: str) -> str:
    k = ", ".join(keys)
    return f"select {k}, count(*) as n from {src} group by {k}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}


def _load() -> None:
    from ledgerly.plans import q_io, q_layers, q_ops, q_stream  # noqa: F401
