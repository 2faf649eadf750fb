"""Receipt files that the writing tasks name."""

import pytest
from pyspark.sql import functions as F

from ledgerly.contracts import RAW
from ledgerly.functions import file_prefix
from ledgerly.session import scratch_path
from ledgerly.sources.csv import read_receipts
from ledgerly.sources.files import SUFFIX, write_receipt_files

HARD = ["plain", "a|b", 'say "x"', "", None, "é ñ", " padded ", "back\\slash", "#mark", "-1,5"]


def receipts(spark, n=60):
    names = RAW.fieldNames()
    rows = [tuple(HARD[(i + j) % len(HARD)] for j in range(len(names) - 1)) + (str(i),) for i in range(n)]
    return spark.createDataFrame(rows, RAW).repartition(3)


def label():
    return F.element_at(F.array(F.lit("2021"), F.lit("2022"), F.lit(None)),
                        (F.col(f"`{RAW.fieldNames()[-1]}`").cast("int") % 3 + 1))


def listed(spark, path):
    return {r[0] for r in spark.read.format("binaryFile").load(path).select("_metadata.file_name").collect()}


def test_rows_and_names(spark):
    raw, path = receipts(spark), scratch_path(spark, "files")
    names = write_receipt_files(spark, raw, label(), path)
    assert listed(spark, path) == set(names) and all(n.endswith(SUFFIX) for n in names)
    back = read_receipts(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, as_spark_writes(spark, raw).collect()))
    by_name = back.withColumn("S", file_prefix()).groupBy("S").count().collect()
    assert {r[0]: r[1] for r in by_name} == {"2021": 20, "2022": 20, "none": 20}


def as_spark_writes(spark, raw):
    path = scratch_path(spark, "plain")
    raw.write.mode("overwrite").option("header", True).option("sep", "|").csv(path)
    return read_receipts(spark, path)


def test_a_folder_takes_several_extracts_and_none(spark):
    path = scratch_path(spark, "files")
    assert write_receipt_files(spark, receipts(spark).limit(0), label(), path) == []
    first = write_receipt_files(spark, receipts(spark), label(), path)
    second = write_receipt_files(spark, receipts(spark), label(), path)
    assert len({*first, *second}) == len(first) + len(second)
    assert read_receipts(spark, path).count() == 120


def test_a_failed_extract_leaves_no_file(spark):
    path = scratch_path(spark, "files")
    number = F.col(f"`{RAW.fieldNames()[-1]}`")
    bad = F.when(number == "59", F.raise_error(F.lit("broken row"))).otherwise(F.lit("2021"))
    with pytest.raises(Exception, match="broken row"):
        write_receipt_files(spark, receipts(spark).coalesce(1).orderBy(number.cast("int")), bad, path)
    assert listed(spark, path) == set()


def test_field_counts_with_and_without_quotes(spark):
    from ledgerly.sources.csv import receipt_field_counts
    path = scratch_path(spark, "fields")
    lines = ["", "a", "a|b", "|", 'a|"b|c"|d', 'a|"b|c', 'a"|b"|c|"d', "é||ñ|"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    got = {r["n_fields"]: r["n"] for r in receipt_field_counts(spark, path).collect()}
    outside = r'\|(?=(?:[^"]*"[^"]*")*[^"]*$)'
    want = spark.createDataFrame([(x,) for x in lines], "value string").groupBy(
        F.size(F.split("value", outside, -1)).alias("n")).count().collect()
    assert got == {r[0]: r[1] for r in want}


def test_field_counts_search_no_pattern_in_plain_lines(spark):
    """The pattern reads the rest of the line at every separator."""
    import time
    from ledgerly.sources.csv import receipt_field_counts
    path = scratch_path(spark, "fields")
    spark.createDataFrame([("|" * 60_000,)], "value string").write.mode("overwrite").text(path)
    t0 = time.monotonic()
    assert [r["n_fields"] for r in receipt_field_counts(spark, path).collect()] == [60_001]
    assert time.monotonic() - t0 < 8
