"""Sinks, filters and reference sources."""

from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.operators.filters import by_event, by_nature, line_filter
from ledgerly.session import scratch_path
from ledgerly.sinks import export_csv, full_refresh, publish
from ledgerly.sources.csv import read_reference


def test_publish_table_and_path(spark, layers):
    ps = layers.ledger
    publish(ps, "ps_ledger", as_table=True)
    assert spark.table("ps_ledger").count() == ps.count()
    path = publish(ps, scratch_path(spark, "ps"))
    assert spark.read.parquet(path).count() == ps.count()


def test_full_refresh_conforms(spark, layers):
    scrambled = layers.postings.select(*reversed(layers.postings.columns), F.lit(1).alias("x"))
    path = full_refresh(scrambled, C.POSTINGS, scratch_path(spark, "f2"))
    back = spark.read.parquet(path)
    assert back.columns == C.POSTINGS.fieldNames()
    assert back.exceptAll(layers.postings).count() == 0


def test_single_file_export(spark, layers):
    path = export_csv(layers.ledger, scratch_path(spark, "ps1"), single_file=True, sep=";")
    files = [f for f in spark.sparkContext.wholeTextFiles(path).keys().collect()
             if f.endswith(".csv")]
    assert len(files) == 1
    assert read_reference(spark, path, sep=";", schema=C.LEDGER).count() == layers.ledger.count()


def test_filters(layers):
    p = layers.postings
    one = p.select("TR_ID_EVNEG").first()[0]
    assert by_event(p, one).count() >= 1
    assert by_nature(p, 1).count() + by_nature(p, 2).count() == p.count()
    assert line_filter(layers.f0).filter(~F.col("COD_RAMO").isin("01", "04", "06")).count() == 0


def _write(path, text, encoding="utf-8"):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.csv", "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_receipts_by_position_with_other_header_spelling(spark):
    from ledgerly.contracts import RAW_NAMES
    from ledgerly.operators.normalize import normalize_receipts
    from ledgerly.sources.csv import read_receipts
    header = [n.replace("RAMO_CONT.", "RAMO CONT.").replace("MODALI.CONT.", "MODALI. CONT.")
              .replace("TIPO_DOC.", "TIPO DOC.") for n in RAW_NAMES]
    full = ["P1", "01", "000", "C1", "M0", "R1", "100,50", "0,00", "7,25", "1,00", "", "0,10",
            "1,00", "120,00", "1995-01-01", "1996-01-01", "1995-01", "0001-01", "1995-03",
            "", "RPA", "1", "C", "42", "1995-02", "N", "0,00"]
    short = full[:10]                      # NULL-padded
    long_ = full + ["extra", "fields"]     # truncated
    text = "|".join(header) + "\n" + "\n".join("|".join(r) for r in (full, short, long_)) + "\n"
    path = _write(scratch_path(spark, "v2hdr").replace("file:", ""), text)
    raw = read_receipts(spark, path)
    assert raw.columns == RAW_NAMES and raw.count() == 3
    f0 = {r.COD_POLIZA + str(i): r for i, r in enumerate(normalize_receipts(raw).collect())}
    rows = list(f0.values())
    assert str(rows[0].IMP_PRIM_TARIFA) == "100.50" and rows[0].COD_EST_REC == "CB"
    assert rows[0].COD_AGENCIA == "C" and rows[0].COD_TIP_GESTION == "D"
    assert rows[1].FEC_EMI is None and rows[1].COD_EST_REC == "NA"
    assert rows[2].IMP_DESCUENTO is not None     # last real field kept, extras dropped


def test_typed_reference_latin1(spark):
    text = ("ID_MAE_CUENTA,COD_SOCIEDAD,NUM_CUENTA,DESC_CUENTA,PADRE,IND_TIPO,TABLA_AUX,CAMPO_AUX\n"
            "M1,SSL1,4300000001,Deudores compañía,,1,,COD_MEDIADOR\n")
    path = _write(scratch_path(spark, "latin").replace("file:", ""), text, "ISO-8859-1")
    df = read_reference(spark, path, schema=C.CHART_OF_ACCOUNTS, encoding="ISO-8859-1")
    r = df.first()
    assert r.DESC_CUENTA == "Deudores compañía" and str(r.NUM_CUENTA) == "4300000001"
    assert r.PADRE is None


def test_header_only_reference_is_text(spark):
    path = _write(scratch_path(spark, "ref").replace("file:", ""),
                  "COD_SOCIEDAD;ID_ESTRUCTURA;COD_ASIENTO;NOM_IMPORTE;NATURALEZA\nSSL1;E;CB01;PRIMA;1\n")
    df = read_reference(spark, path, sep=";")
    assert df.columns == C.ENTRY_STRUCTURE.fieldNames()
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)
