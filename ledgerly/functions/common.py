"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: Column | str) -> Column:
    """A column by literal name: dots and spaces in names are not struct paths."""
    if isinstance(c, Column):
        return c
    return F.col("`" + c.replace("`", "``") + "`")


def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit_sql(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def all_names(*cols) -> bool:
    """True when every argument is a column name (then the function is built
    as one SQL expression: one JVM call instead of one per operator)."""
    return all(isinstance(c, str) for c in cols)
