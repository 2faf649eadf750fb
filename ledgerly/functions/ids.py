"""Deterministic surrogate keys.

An id is the SHA-256 of the natural key, so it does not depend on partitioning,
file order or re-execution after an executor loss (unlike a position-based id).
Each part is length-prefixed (``<len>:<text>``) and NULL is ``-``, so distinct
keys can never produce the same text before hashing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerly.functions.common import all_names, column, ident


def key_text(*parts: Column | str) -> Column:
    if all_names(*parts):
        enc_sql = [f"coalesce(concat(cast(length({ident(p)}) as string), ':', "
                   f"cast({ident(p)} as string)), '-')" for p in parts]
        return F.expr(f"concat_ws(',', {', '.join(enc_sql)})")
    enc = []
    for p in parts:
        c = column(p).cast("string")
        enc.append(F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c),
                              F.lit("-")))
    return F.concat_ws(",", *enc)


def event_id(*parts: Column | str) -> Column:
    """Hex SHA-256 of the encoded natural key."""
    return F.sha2(key_text(*parts), 256)
