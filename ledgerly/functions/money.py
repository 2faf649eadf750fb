"""Tolerant parsing of decimal-comma money text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerly.contracts import MONEY
from ledgerly.functions.common import all_names, column, ident


def money(c: Column | str) -> Column:
    """``'12,34'`` -> 12.34 as decimal(13,2).

    Every ``,`` becomes ``.``, then ``try_cast``: empty, malformed
    (``1.234,56``) or overflowing text gives NULL rather than an error.
    """
    if all_names(c):
        return F.expr(f"try_cast(replace({ident(c)}, ',', '.') as decimal(13,2))")
    return F.replace(column(c), F.lit(","), F.lit(".")).try_cast(MONEY)
