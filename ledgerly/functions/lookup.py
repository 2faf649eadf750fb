"""Dynamic column lookup: read the column whose *name* is stored in data.

The candidate names are known at plan time (they come from small rule tables),
so the lookup is an ordinary ``CASE`` over those columns: it stays a JVM
expression, keeps whole-stage codegen, and lets Catalyst prune every column
that no rule names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ledgerly.functions.common import column


class UnknownColumnError(ValueError):
    """A rule names a column the event frame does not have."""


def check_columns(df: DataFrame, names: Iterable[str], what: str) -> list[str]:
    names = sorted({n for n in names if n is not None})
    present = set(df.columns)
    missing = [n for n in names if n not in present]
    if missing:
        raise UnknownColumnError(f"{what} names unknown columns: {missing}")
    return names


def pick_column(name_col: Column | str, candidates: Iterable[str],
                dtype: DataType | None = None) -> Column:
    """Value of the column named by ``name_col`` (NULL when no candidate matches).

    ``dtype`` is the common result type; every candidate is converted to it.
    """
    sel = column(name_col)
    expr = None
    for n in candidates:
        v = column(n) if dtype is None else column(n).try_cast(dtype)
        expr = F.when(sel == n, v) if expr is None else expr.when(sel == n, v)
    if expr is None:
        return F.lit(None).cast(dtype or StringType())
    return expr


def column_equals(df: DataFrame, name_col: Column | str, value_col: Column | str,
                  candidates: Iterable[str]) -> Column:
    """Predicate: ``df[<name in name_col>] == value_col``.

    Each comparison is made in the named column's own type (the text value is
    converted with ``try_cast``), so ``10`` matches ``10.00`` on a decimal
    column; NULL on either side never matches.
    """
    sel, val = column(name_col), column(value_col)
    types = {f.name: f.dataType for f in df.schema.fields}
    expr = None
    for n in candidates:
        dtype = types[n]
        rhs = val if isinstance(dtype, StringType) else val.try_cast(dtype)
        cond = F.coalesce(column(n) == rhs, F.lit(False))
        expr = F.when(sel == n, cond) if expr is None else expr.when(sel == n, cond)
    if expr is None:
        return F.lit(False)
    return expr.otherwise(F.lit(False))


def posting_description(kind: Column | str, description: Column | str,
                        aux_value: Column) -> Column:
    """Account text: ``'<desc> - <value>'`` for kind 1, else the plain text.

    In the composed form NULL parts print as ``null``, as text interpolation
    does. A kind that is not an integer yields NULL here; ``postings`` routes
    such rows to the reject report instead of emitting them.
    """
    k = column(kind).try_cast("int")
    desc = column(description)
    composed = F.concat(F.coalesce(desc, F.lit("null")), F.lit(" - "),
                        F.coalesce(aux_value.cast("string"), F.lit("null")))
    return F.when(k == 1, composed).when(k.isNotNull(), desc)
