"""Registered queries for sources, sinks and contracts (write, read back)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.functions import column, file_prefix, management_type
from ledgerly.operators.enrich import product_dimension
from ledgerly.operators.normalize import normalize_receipts
from ledgerly.plans import oracle as O
from ledgerly.plans.layers import fixture_layers
from ledgerly.plans.registry import SUM_TYPE, register
from ledgerly.session import scratch_path
from ledgerly.sinks import export_csv, full_refresh
from ledgerly.sources.csv import read_reference, read_receipts, receipt_field_counts
from ledgerly.sources.files import write_receipt_files
from ledgerly.sources.tables import load_table

_F0_SQL = O.with_ctes(f"select {O.F0_COLS} from f0")


@register("conform_contract", _F0_SQL)
def q_conform_contract(spark, sf):
    """F0 with columns reversed, money as text and an extra column, conformed back."""
    f0 = fixture_layers(spark, sf).f0
    scrambled = f0.select(
        F.lit("x").alias("UNUSED"),
        *[(F.col(f.name).cast("string") if f.dataType == C.MONEY else F.col(f.name))
          .alias(f.name) for f in reversed(C.F0.fields)])
    return C.conform(scrambled, C.F0)


@register("full_refresh_roundtrip",
          O.with_ctes(f"select {', '.join(C.F1.fieldNames())} from f1"))
def q_full_refresh_roundtrip(spark, sf):
    path = full_refresh(fixture_layers(spark, sf).f1, C.F1, scratch_path(spark, "f1"))
    return spark.read.parquet(path)


@register("contract_table_roundtrip",
          O.with_ctes(f"select {', '.join(C.F1.fieldNames())} from f1"))
def q_contract_table_roundtrip(spark, sf):
    """F1 inserted by position into a table made from its contract."""
    import uuid

    from ledgerly.sinks import create_table
    name, folder = f"ledgerly_f1_{uuid.uuid4().hex[:8]}", scratch_path(spark, "f1-table")
    for _ in range(2):  # dropped and made again
        create_table(spark, name, C.F1, folder)
    C.conform(fixture_layers(spark, sf).f1, C.F1).write.insertInto(name)
    stored = spark.read.schema(spark.table(name).schema).parquet(folder)
    spark.sql(f"drop table {name}")  # external: the files stay
    return stored


@register("receipt_field_counts", O.with_ctes(
    'select substr("F.EFECTO", 1, 4) as SOURCE, cast(27 as integer) as n_fields, count(*) as n '
    "from raw group by 1"))
def q_receipt_field_counts(spark, sf):
    """Control of the extract's files: lines by number of fields."""
    return receipt_field_counts(spark, receipt_files(spark, sf))


@register("receipts_csv_roundtrip", _F0_SQL)
def q_receipts_csv_roundtrip(spark, sf):
    path = export_csv(fixture_layers(spark, sf).raw, scratch_path(spark, "raw"), sep="|")
    return normalize_receipts(read_receipts(spark, path))


@register("reference_csv_roundtrip", O.with_ctes(
    'select distinct "MEDIADOR" as COD_MEDIADOR, "T.MEDIADOR" as TIPO_MEDIADOR, '
    """case when "T.MEDIADOR" in ('C','E','X') then 'D' else 'C' end as TIPO_GESTION """
    "from raw"))
def q_reference_csv_roundtrip(spark, sf):
    """A mediator reference table derived from the receipts, written ``;``-
    separated with a header and read back as text."""
    raw = fixture_layers(spark, sf).raw
    ref = raw.select(column("MEDIADOR").alias("COD_MEDIADOR"),
                     column("T.MEDIADOR").alias("TIPO_MEDIADOR"),
                     management_type("T.MEDIADOR").alias("TIPO_GESTION")).distinct()
    path = export_csv(ref, scratch_path(spark, "mediators"), sep=";")
    return read_reference(spark, path, sep=";")


_CHART_DESC_PREFIX = "Acreedor Compañía "


@register("typed_reference_roundtrip", O.with_ctes(
    "select 'S' || cast(s_suppkey as varchar) as ID_MAE_CUENTA, 'SSL1' as COD_SOCIEDAD, "
    "cast(4000000000 + s_suppkey as decimal(10,0)) as NUM_CUENTA, "
    f"'{_CHART_DESC_PREFIX}' || s_name as DESC_CUENTA, {'cast(null as varchar)'} as PADRE, "
    "'0' as IND_TIPO, cast(null as varchar) as TABLA_AUX, cast(null as varchar) as CAMPO_AUX "
    "from supplier"))
def q_typed_reference_roundtrip(spark, sf):
    """A chart of accounts derived from ``supplier``, exported in ISO-8859-1
    and read back with its typed schema (decimal account numbers)."""
    sup = load_table(spark, sf, "supplier")
    chart = sup.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ID_MAE_CUENTA"),
        F.lit("SSL1").alias("COD_SOCIEDAD"),
        (F.lit(4000000000) + F.col("s_suppkey")).cast(C.ACCOUNT).alias("NUM_CUENTA"),
        F.concat(F.lit(_CHART_DESC_PREFIX), F.col("s_name")).alias("DESC_CUENTA"),
        F.lit(None).cast("string").alias("PADRE"), F.lit("0").alias("IND_TIPO"),
        F.lit(None).cast("string").alias("TABLA_AUX"),
        F.lit(None).cast("string").alias("CAMPO_AUX"))
    path = export_csv(chart, scratch_path(spark, "chart"), encoding="ISO-8859-1")
    return read_reference(spark, path, schema=C.CHART_OF_ACCOUNTS, encoding="ISO-8859-1")


# Business names of the derived product table.
_DIM_BUSINESS = """case "RAMO" when '04' then 'VIDA' when '06' then null else 'NO VIDA' end"""
_DIM_KIND = """case "MODALIDAD" when '000' then 'BASICO' when '001' then null else 'PLUS' end"""


@register("reference_dedup", O.with_ctes(
    "select coalesce(RAMO_POL, '') as RAMO_POL, coalesce(MODALIDAD_POL, '') as MODALIDAD_POL, "
    "coalesce(Negocio, '') as Negocio, coalesce(\"Tipo de Negocio\", '') as Tipo_de_negocio "
    f'from (select distinct "RAMO" as RAMO_POL, "MODALIDAD" as MODALIDAD_POL, {_DIM_BUSINESS} as Negocio, '
    f'{_DIM_KIND} as "Tipo de Negocio" from raw)'))
def q_reference_dedup(spark, sf):
    """Product dimension preparation (distinct, rename, NULL -> '') over a
    product table derived from every receipt line."""
    raw = fixture_layers(spark, sf).raw
    dim_raw = raw.select(column("RAMO").alias("RAMO_POL"),
                         column("MODALIDAD").alias("MODALIDAD_POL"),
                         F.expr(_DIM_BUSINESS.replace('"', "`")).alias("Negocio"),
                         F.expr(_DIM_KIND.replace('"', "`")).alias("Tipo de Negocio"))
    return product_dimension(dim_raw)


_LEDGER_NULLED = ", ".join(
    (f"nullif({f.name}, '') as {f.name}" if f.dataType == C.LEDGER["DIV"].dataType
     else f.name) for f in C.LEDGER.fields)


@register("csv_export_roundtrip", O.with_ctes(
    f"select {_LEDGER_NULLED} from ps", {"ps": O.ledger_select()}))
def q_csv_export_roundtrip(spark, sf):
    """PS exported as an interface CSV and read back with its contract
    (empty text comes back as NULL)."""
    path = export_csv(fixture_layers(spark, sf).ledger, scratch_path(spark, "ps_csv"))
    return read_reference(spark, path, schema=C.LEDGER)


def year_label():
    return F.substring(column("F.EFECTO"), 1, 4)


def receipt_files(spark, sf) -> str:
    """Receipts of the driver tables as pipe files named by effect year."""
    return write_extract(spark, fixture_layers(spark, sf).raw)[0]


def write_extract(spark, raw, target: str | None = None) -> tuple[str, int]:
    """An extract as pipe files (one per year and writing task): folder, number."""
    target = target or scratch_path(spark, "receipt-files")
    return target, len(write_receipt_files(spark, raw, year_label(), target))


@register("file_provenance", O.with_ctes(
    'select substr("F.EFECTO", 1, 4) as SOURCE, count(*) as n, '
    f"""cast(sum({O._m('IMP.PRIMA')}) as {SUM_TYPE}) as premium from raw group by 1"""))
def q_file_provenance(spark, sf):
    from ledgerly.functions import money
    df = read_receipts(spark, receipt_files(spark, sf)).withColumn("SOURCE", file_prefix())
    return df.groupBy("SOURCE").agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(money("IMP.PRIMA")).cast(SUM_TYPE).alias("premium"))


@register("publish_table_roundtrip", O.with_ctes(
    f"select {', '.join(C.LEDGER.fieldNames())} from ps", {"ps": O.ledger_select()}))
def q_publish_table_roundtrip(spark, sf):
    """PS saved as an external catalog table (overwrite), read back by name."""
    import uuid

    from ledgerly.sinks import publish
    name = f"ledgerly_ps_{uuid.uuid4().hex[:8]}"
    folder = scratch_path(spark, "ps_table")
    publish(fixture_layers(spark, sf).ledger, name, as_table=True, path=folder)
    stored = spark.read.schema(spark.table(name).schema).parquet(folder)
    spark.sql(f"drop table {name}")  # external: the files stay
    return stored
