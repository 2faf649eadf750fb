import pytest
from pyspark.sql import functions as F

from ledgerly import contracts as C


def test_contract_widths():
    assert (len(C.RAW.fields), len(C.F0.fields), len(C.F1.fields),
            len(C.POSTINGS.fields), len(C.LEDGER.fields)) == (27, 53, 59, 9, 22)
    assert sum(1 for f in C.F0.fields if f.dataType == C.MONEY) == 19


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame([("12.5", "x", 1)], "TR_CC_IMP string, TR_ID_EVNEG string, z int")
    df = df.withColumns({n: F.lit(None).cast("string") for n in C.POSTINGS.fieldNames()
                         if n not in df.columns})
    out = C.conform(df, C.POSTINGS)
    assert out.schema == C.POSTINGS
    assert str(out.first().TR_CC_IMP) == "12.50"


def test_conform_missing_column(spark):
    df = spark.createDataFrame([("a",)], "TR_ID_EVNEG string")
    with pytest.raises(C.ContractError, match="TR_CC_IMP"):
        C.conform(df, C.POSTINGS)


def test_conform_bad_value_is_null(spark):
    df = spark.createDataFrame([("abc",)], "IMP string")
    df = df.select(*[(F.col("IMP") if n == "IMP" else F.lit("")).alias(n)
                     for n in C.LEDGER.fieldNames()])
    assert C.conform(df, C.LEDGER).first().IMP is None


def test_positional_names(spark):
    df = spark.createDataFrame([tuple(["v"] * 27)], ", ".join(f"c{i} string" for i in range(27)))
    assert C.positional(df, C.RAW).columns == C.RAW_NAMES
    with pytest.raises(C.ContractError):
        C.positional(df.drop("c0"), C.RAW)
