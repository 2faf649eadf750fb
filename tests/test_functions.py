from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerly.functions import (
    AGENCY_CODES,
    column_equals,
    entry_type,
    event_id,
    event_key,
    management_type,
    money,
    pick_column,
    posting_description,
    receipt_status,
    settlement_date,
    translate_codes,
)


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


@pytest.mark.parametrize("text,expected", [
    (None, None), ("", None), (" 7 ", Decimal("7.00")), ("12,345", Decimal("12.35")),
    ("-12,345", Decimal("-12.35")), ("1.234,56", None), ("123456789012,00", None),
    ("0,10", Decimal("0.10")), ("abc", None),
])
def test_money(spark, text, expected):
    assert one(spark, money("m"), [(text,)], "m string") == [expected]


NEVER = "0001-01"


@pytest.mark.parametrize("car,anu,cob,status,fec", [
    ("2020-01", NEVER, "2020-03", "CB", "2020-03"),
    ("2020-01", "2020-02", NEVER, "DV", "2020-02"),
    ("2020-01", NEVER, NEVER, "PT", "2020-01"),
    (NEVER, NEVER, NEVER, "NA", ""),
    ("2020-05", "2020-02", NEVER, "NA", ""),       # cancelled before charge
    ("2020-01", "2020-01", "2020-01", "CB", "2020-01"),  # equal dates
    (None, NEVER, "2020-03", "NA", ""),            # NULL charge: CB/DV/PT fail
    ("2020-01", None, "2020-03", "NA", ""),
    ("2020-01", NEVER, None, "NA", ""),
    ("2020-04", NEVER, "2020-03", "NA", ""),       # collected before charged
])
def test_status_and_settlement(spark, car, anu, cob, status, fec):
    df = spark.createDataFrame([(car, anu, cob)], "car string, anu string, cob string")
    st = receipt_status("car", "anu", "cob")
    r = df.select(st.alias("s"), settlement_date(st, "car", "anu", "cob").alias("f")).first()
    assert (r.s, r.f) == (status, fec)


def test_management_type(spark):
    got = one(spark, management_type("t"), [(c,) for c in ["C", "E", "X", "L", "A", None]],
              "t string")
    assert got == ["D", "D", "D", "C", "C", "C"]


def test_translate_codes_pass_through(spark):
    got = one(spark, translate_codes("c", AGENCY_CODES),
              [(c,) for c in ["C", "E", "X", "L", "S", "U", "A", None]], "c string")
    assert got == ["CORR", "ECOL", "AGEX", "SLU", "SLU", "SLU", "A", None]


def test_event_key_and_entry_type(spark):
    df = spark.createDataFrame([("RPRI", "COB", "CB01"), (None, "PTE", "E")],
                               "a string, b string, c string")
    rows = df.select(event_key("a", "b").alias("k"), entry_type("c").alias("t")).collect()
    assert [(r.k, r.t) for r in rows] == [("RPRI_COB", "CB"), ("PTE", "E")]


def test_event_id_no_collisions(spark):
    rows = [("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a,b", "", None),
            ("a", ",b", None), ("a", "b", "")]
    ids = one(spark, event_id("x", "y", "z"), rows, "x string, y string, z string")
    assert len(set(ids)) == len(rows)
    assert ids == one(spark, event_id("x", "y", "z"), rows, "x string, y string, z string")


def test_pick_column_and_typed_equality(spark):
    df = spark.createDataFrame(
        [("A", Decimal("10.00"), "x", "A", "10"), ("B", Decimal("10.00"), "x", "B", "x"),
         ("C", Decimal("1.00"), None, "B", None)],
        "sel string, A decimal(13,2), B string, name string, val string")
    got = df.select(pick_column("sel", ["A", "B"], "string").alias("p"),
                    column_equals(df, "name", "val", ["A", "B"]).alias("eq")).collect()
    assert [(r.p, r.eq) for r in got] == [("10.00", True), ("x", True), (None, False)]


@pytest.mark.parametrize("kind,desc,aux,expected", [
    ("1", "Deudores", "123", "Deudores - 123"),
    ("1", "Deudores", None, "Deudores - null"),
    ("1", None, "9", "null - 9"),
    ("0", "Primas", "9", "Primas"),
    (None, "Primas", "9", None),
    ("x", "Primas", "9", None),
])
def test_posting_description(spark, kind, desc, aux, expected):
    df = spark.createDataFrame([(kind, desc, aux)], "k string, d string, a string")
    assert df.select(posting_description("k", "d", F.col("a"))).first()[0] == expected


def test_wide_projections_are_split_for_the_compiler(spark, layers):
    from ledgerly.session import compiled_methods
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        assert layers.raw.count() and compiled_methods(spark) is None
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "9000")
        compiled_methods(spark)
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.set(key, before)
