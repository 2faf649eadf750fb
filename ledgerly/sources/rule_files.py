"""Rule and reference tables stored as delimited files in one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerly import contracts as C
from ledgerly.sinks import export_csv
from ledgerly.sources.csv import read_reference
from ledgerly.sources.files import _fs

# File name, separator, typed schema (None = all text, names
# from the header) and text encoding of every rule/reference table.
RULE_FILES = {
    "product_dim": ("TR_RAMO_POL.csv", ",", None, None),
    "event_master": ("maestro_eventos_negocio.csv", ",", None, None),
    "accounting_events": ("maestro_eventos_contables.csv", ",", None, None),
    "event_relation": ("relacion_eventos.csv", ",", None, None),
    "entry_structure": ("asientos_estructura_basica.csv", ";", None, None),
    "entry_amounts": ("asientos_importes.csv", ";", None, None),
    "account_rules": ("asientos_cuentas_contables.csv", ",", C.ACCOUNT_RULES, None),
    "chart_of_accounts": ("maestro_cuentas_contables.csv", ",", C.CHART_OF_ACCOUNTS,
                          "ISO-8859-1"),
}


def read_rule_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every rule/reference table present in ``folder`` (a file or a folder
    of part files per name). The accounting-event master is loaded when
    present but nothing downstream reads it."""
    out = {}
    for key, (name, sep, schema, encoding) in RULE_FILES.items():
        path = f"{folder.rstrip('/')}/{name}"
        fs, jvm = _fs(spark, path)
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
            continue
        out[key] = read_reference(spark, path, sep=sep, schema=schema, encoding=encoding)
    return out


def write_rule_tables(tables: dict[str, DataFrame], folder: str) -> str:
    """Export rule tables in the same layout ``read_rule_tables`` reads."""
    for key, df in tables.items():
        name, sep, _, encoding = RULE_FILES[key]
        export_csv(df, f"{folder.rstrip('/')}/{name}", sep=sep, single_file=True,
                   encoding=encoding)
    return folder
