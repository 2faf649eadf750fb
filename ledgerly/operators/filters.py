"""Row filters over receipts and postings (pushed down by Catalyst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Product lines used for the case grid (non-life, life).
NON_LIFE_LINES = ("01", "06")
LIFE_LINES = ("04",)


def line_filter(df: DataFrame, codes=NON_LIFE_LINES + LIFE_LINES,
                col: str = "COD_RAMO") -> DataFrame:
    """Rows whose product line is one of ``codes``."""
    return df.filter(F.col(col).isin(*codes))


def by_nature(postings: DataFrame, nature: int) -> DataFrame:
    """Postings of one nature; the text column is compared as an integer."""
    return postings.filter(F.col("TR_NAT_EVCON").try_cast("int") == nature)


def by_event(postings: DataFrame, event_id: str) -> DataFrame:
    return postings.filter(F.col("TR_ID_EVNEG") == event_id)
