"""Rule and reference tables used by the registered queries and tests.

The values are configuration, kept here once; ``plans.oracle`` renders the same
lists as SQL ``VALUES`` so both engines read identical rules.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerly import contracts as C

# Company, entry codes and the rule tables of the test fixture.
COMPANY = "SSL1"
ENTRIES = ["CB01", "CM01", "EM01", "DV01"]

EVENT_MASTER_ROWS = [("RPRI_COB",), ("RPRI_PTE",), ("RPRI_DEV",), ("RSUP_COB",),
                     ("RSUP_PTE",)]

EVENT_RELATION_ROWS = [("RPRI_COB", "CB01"), ("RPRI_COB", "CM01"), ("RPRI_PTE", "EM01"),
                       ("RPRI_DEV", "DV01"), ("RSUP_COB", "CB01"), ("RSUP_PTE", "EM01")]

STRUCTURE_LINES = [("PRIMA", "1"), ("PRIMA", "2"), ("IPS", "2")]
AMOUNT_FIELDS = [("PRIMA", "IMP_PRIM_TARIFA"), ("IPS", "IPS")]
ACCOUNT_RULE_CELLS = [
    ("TR_COD_AGENCIA", "CORR", Decimal(4300000001)),
    ("TR_COD_AGENCIA", "SLU", Decimal(4300000002)),
    ("COD_RAMO", "04", Decimal(7000000001)),
    ("COD_RAMO", "01", Decimal(7000000002)),
    ("COD_RAMO", "09", None),
]
CHART_ROWS = [
    (Decimal(4300000001), "Deudores corredor", "1", "COD_MEDIADOR"),
    (Decimal(4300000002), "Deudores directos", "0", None),
    (Decimal(7000000001), "Primas vida", "0", None),
    (Decimal(7000000002), "Primas no vida", "0", None),
]
PRODUCT_ROWS = [
    ("1", "0", "NO VIDA", "DECESOS"),
    ("01", "1", "NO VIDA", "HOGAR"),
    ("4", "0", "VIDA", "AHORRO"),
    ("4", "01", "VIDA", "RIESGO"),
    ("6", "2", None, "ACCID"),
]


def structure_id(entry: str) -> str:
    return f"{entry}-E"


def structure_rows() -> list[tuple]:
    return [(COMPANY, structure_id(e), e, amt, nat)
            for e in ENTRIES for amt, nat in STRUCTURE_LINES]


def amount_rows() -> list[tuple]:
    return [(COMPANY, structure_id(e), e, amt, field)
            for e in ENTRIES for amt, field in AMOUNT_FIELDS]


def account_rule_rows() -> list[tuple]:
    rows = []
    for e in ENTRIES:
        for nature in (1, 2):
            for i, (name, value, account) in enumerate(ACCOUNT_RULE_CELLS, start=1):
                rows.append((COMPANY, f"{e}-{nature}-{i}", structure_id(e), e, nature,
                             name, value, None, account))
    return rows


def chart_rows() -> list[tuple]:
    return [(f"M{i}", COMPANY, num, desc, None, kind, None, aux)
            for i, (num, desc, kind, aux) in enumerate(CHART_ROWS, start=1)]


def product_rows() -> list[tuple]:
    return list(PRODUCT_ROWS)


def sql_literal(v) -> str:
    """A value as a SQL literal that Spark and DuckDB read alike."""
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, Decimal):
        return f"CAST({v} AS DECIMAL(38,{max(0, -v.as_tuple().exponent)}))"
    return str(int(v))


def values_sql(rows: list[tuple], schema: StructType, quote: str = "`") -> str:
    """``SELECT`` over inline ``VALUES`` with every column cast to ``schema``."""
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    names = [f.name for f in schema.fields]
    alias = ", ".join(f"c{i}" for i in range(len(names)))
    cols = ", ".join(
        f"CAST(c{i} AS {f.dataType.simpleString().upper()}) AS {quote}{f.name}{quote}"
        for i, f in enumerate(schema.fields))
    return f"SELECT {cols} FROM (VALUES {body}) AS t({alias})"


FIXTURE_SCHEMAS = {
    "event_master": C.EVENT_MASTER,
    "event_relation": C.EVENT_RELATION,
    "entry_structure": C.ENTRY_STRUCTURE,
    "entry_amounts": C.ENTRY_AMOUNTS,
    "account_rules": C.ACCOUNT_RULES,
    "chart_of_accounts": C.CHART_OF_ACCOUNTS,
    "product_dim": C.PRODUCT_DIM_RAW,
}


def fixture_rows() -> dict[str, list[tuple]]:
    return {
        "event_master": list(EVENT_MASTER_ROWS),
        "event_relation": list(EVENT_RELATION_ROWS),
        "entry_structure": structure_rows(),
        "entry_amounts": amount_rows(),
        "account_rules": account_rule_rows(),
        "chart_of_accounts": chart_rows(),
        "product_dim": product_rows(),
    }


def fixture_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The six rule tables and the raw product dimension.

    Built from inline ``VALUES`` so each is a JVM local relation with exact
    size statistics (no Python-side scan).
    """
    rows = fixture_rows()
    return {k: spark.sql(values_sql(rows[k], FIXTURE_SCHEMAS[k]))
            for k in FIXTURE_SCHEMAS}
