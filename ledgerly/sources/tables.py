"""Catalog/parquet table sources and the receipt extract derived from them.

``raw_receipts`` turns the driver's ``lineitem`` x ``orders`` tables into the
27-column pipe-extract layout (one receipt line per order line), so every query
works on data that grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.contracts import RAW_NAMES
from ledgerly.session import compiled_methods


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-repartition ``df`` on ``key`` only when its scan yields fewer
    partitions than the cluster runs in parallel (a small file with one row
    group is a single task). Large inputs already split into many scan tasks
    and are left alone, so no shuffle is added at scale."""
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < parallelism:
        return df.repartition(parallelism, key)
    return df


def _money_text(c: str) -> str:
    return f"replace(cast(cast({c} as decimal(13,2)) as string), '.', ',')"


def _month_text(c: str, shift: int = 0) -> str:
    """``YYYY-MM`` of timestamp ``c`` moved ``shift`` months, by integer
    arithmetic on year and month (same text as formatting the shifted
    timestamp, without calendar arithmetic per row)."""
    idx = f"(year({c}) * 12 + month({c}) - 1 + {shift})"
    return (f"concat(lpad(cast(div({idx}, 12) as string), 4, '0'), '-', "
            f"lpad(cast(pmod({idx}, 12) + 1 as string), 2, '0'))")


# One expression per raw field, in file order.
_RAW_EXPRS = [
    "cast(o_orderkey as string)",
    "lpad(cast(l_linenumber as string), 2, '0')",
    "lpad(cast(l_suppkey % 5 as string), 3, '0')",
    "concat('C', cast(l_linenumber as string))",
    "concat('M', cast(l_suppkey % 5 as string))",
    "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
    "cast(l_partkey as string), cast(l_suppkey as string), "
    "substr(cast(l_shipdate as string), 1, 10))",
    _money_text("l_extendedprice"),
    _money_text("l_discount"),
    _money_text("l_tax"),
    _money_text("l_quantity"),
    "case when l_partkey % 10 = 0 then '' else '1,25' end",
    "case when l_partkey % 10 = 1 then '1.234,56' else '0,10' end",
    _money_text("l_quantity"),
    _money_text("o_totalprice"),
    "substr(cast(o_orderdate as string), 1, 10)",
    "substr(cast(o_orderdate + interval 1 year as string), 1, 10)",
    _month_text("o_orderdate"),
    f"case when l_returnflag = 'R' then {_month_text('l_shipdate')} else '0001-01' end",
    f"case when l_linestatus = 'F' then {_month_text('l_shipdate', 1)} else '0001-01' end",
    "cast(null as string)",
    "case substr(o_orderpriority, 1, 1) when '1' then 'RPA' when '2' then 'RPA' "
    "when '3' then 'RSUP' else 'REXT' end",
    "cast(o_custkey % 50 as string)",
    "substr('CEXLSUA', cast(l_suppkey % 7 as int) + 1, 1)",
    "cast(l_suppkey as string)",
    _month_text("l_shipdate"),
    "'N'",
    "'0,00'",
]

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus", "l_shipdate"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
               "o_orderpriority"]


def raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 27 text fields of the receipt extract, one row per order line.

    The join on the order key is left to Catalyst: a broadcast when ``orders``
    is under the size threshold, a sort-merge join otherwise. Only the listed
    columns are read from parquet.
    """
    compiled_methods(spark)
    li = spread(load_table(spark, sf_dir, "lineitem").select(*LINEITEM_COLS), "l_orderkey")
    o = load_table(spark, sf_dir, "orders").select(*ORDERS_COLS)
    joined = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return joined.select([F.expr(e).alias(n) for e, n in zip(_RAW_EXPRS, RAW_NAMES)])


def receipts_as_of(raw: DataFrame, cut: str, renumbered: bool = True) -> DataFrame:
    """The extract as it looked at month ``cut`` (``YYYY-MM``), from all of it.

    Receipts charged after ``cut`` are not yet there; cancellation and
    collection dates after ``cut`` have not happened yet (``0001-01``); the
    receipts of mediator type ``U`` still have the numbers they had before they
    were renumbered (unless ``renumbered`` is off).
    """
    from ledgerly.functions import column
    never, number = F.lit("0001-01"), column("N.RECIBO")
    masked = raw.filter(column("F.LIQ.CAR.") <= cut)
    for c in ("F.LIQ.ANU.", "F.LIQ.COB."):
        masked = masked.withColumn(c, F.when(column(c) <= cut, column(c)).otherwise(never))
    if not renumbered:
        return masked
    return masked.withColumn("N.RECIBO", F.when(
        column("T.MEDIADOR") == "U", F.concat(F.lit("U"), number)).otherwise(number))
