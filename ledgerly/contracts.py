"""Table contracts for every layer of the receipt ledger, plus ``conform``.

A contract is a plain ``StructType``. ``conform`` projects any frame onto a
contract: it selects the contract's columns in contract order and converts each
one with ``try_cast`` (a value that does not fit becomes NULL instead of failing
the job). A missing column is a plan-time error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(13, 2)
ACCOUNT = DecimalType(10, 0)


def _struct(fields: list[tuple[str, DataType]]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


def _strings(names: list[str]) -> list[tuple[str, DataType]]:
    return [(n, StringType()) for n in names]


# Raw receipt extract, 27 text fields in file order.
RAW_NAMES = [
    "POLIZA", "RAMO", "MODALIDAD", "RAMO_CONT.", "MODALI.CONT.", "N.RECIBO",
    "IMP.PRIMA", "IMP.BONIFIC.", "IMP.IPS", "IMP.CONSORC.", "IMP.CLEA", "IMP.ARB.",
    "IMP.COMI.", "IMP.RECIBO", "F.EFECTO", "F.VENCIM.", "F.LIQ.CAR.", "F.LIQ.ANU.",
    "F.LIQ.COB.", "F.PAGO", "TIPO_DOC.", "AGENCIA", "T.MEDIADOR", "MEDIADOR",
    "C.LIQUIDACION", "T.COMISION", "IMP.DTO.RECIBO",
]
RAW = _struct(_strings(RAW_NAMES))

# F0 receipt layer, 53 columns in table order; the money columns
# are decimal(13,2), everything else text.
F0_MONEY = {
    "IMP_PRIM_TARIFA", "IMP_PRIM_UNIC", "IMP_PRIM_PERIOD", "IMP_PRIM_EXTOR_EJER",
    "IMP_PRIM_EXTOR_EJER_ANT", "IMP_PRIM_ANUL_EJER_ANT", "BON_N_SINIESTRALIDAD",
    "IPS", "TAS_CSS_REC_RIES_EXTR", "TAS_CSS_REC_FUN_LIQ", "TAS_CSS_PRIM_PEND_COBR",
    "ARB_BOMBEROS", "IMP_COMISIONES", "IMP_RETEN_FISC", "IMP_TOT_RECIB",
    "IMP_DESCUENTO", "IMP_PRIM_REAL", "IMP_COA", "PRE_RECOBRADAS",
}
F0_NAMES = [
    "COD_SOCIEDAD", "COD_POLIZA", "COD_RAMO", "COD_MODALIDAD", "COD_GARANTIA",
    "COD_CERTIFICADO", "COD_RECIBO", "MAR_NUEV_RECIBO", "COD_DIVISA",
    "IMP_PRIM_TARIFA", "IMP_PRIM_UNIC", "IMP_PRIM_PERIOD", "IMP_PRIM_EXTOR_EJER",
    "IMP_PRIM_EXTOR_EJER_ANT", "IMP_PRIM_ANUL_EJER_ANT", "BON_N_SINIESTRALIDAD",
    "IPS", "TAS_CSS_REC_RIES_EXTR", "TAS_CSS_REC_FUN_LIQ", "TAS_CSS_PRIM_PEND_COBR",
    "ARB_BOMBEROS", "IMP_COMISIONES", "IMP_RETEN_FISC", "IMP_TOT_RECIB", "CAR_RECIB",
    "ID_MOV_ECON", "FEC_MOV_ECON", "FEC_EMI", "FEC_LIQ", "COD_TIP_RECIB",
    "COD_EST_REC_ANT", "COD_EST_REC", "REC_FRACCIONADO", "MAR_RECIB_SIMUL", "COMP",
    "MAR_REINV", "ENT_COLABORADORA", "COD_TIP_SIN", "COD_AGENCIA", "COD_MEDIADOR",
    "COD_TIP_GESTION", "CON_LIQUIDACION", "IMP_DESCUENTO", "IMP_PRIM_REAL", "IMP_COA",
    "PRE_RECOBRADAS", "NOM_DESTINATARIO", "NOM_POBL", "NIF", "CTA_BANC",
    "ENT_BANCARIA", "TR_COD_RAMO_CONT", "TR_COD_MOD_CONT",
]
F0 = _struct([(n, MONEY if n in F0_MONEY else StringType()) for n in F0_NAMES])

# F1 business events: event id, the F0 columns, five derived codes.
F1_EXTRA = [
    "TR_COD_TIP_RECIB", "TR_COD_EST_RECIB", "TR_COD_AGENCIA", "TR_NEGOCIO",
    "TR_COD_TIP_NEGOCIO",
]
F1 = _struct(
    [("TR_ID_EVNEG", StringType())]
    + [(f.name, f.dataType) for f in F0.fields]
    + _strings(F1_EXTRA)
)

# F2_CONT postings.
POSTINGS = _struct([
    ("TR_ID_EVNEG", StringType()),
    ("TR_COD_RAMO_CONT", StringType()),
    ("TR_COD_MOD_CONT", StringType()),
    ("TR_CUENTA_CONT", ACCOUNT),
    ("TR_COD_TIP_EVCON", StringType()),
    ("TR_ID_EVCON", StringType()),
    ("TR_NAT_EVCON", StringType()),
    ("TR_CC_DES", StringType()),
    ("TR_CC_IMP", MONEY),
])

# PS ledger lines for the ERP interface.
LEDGER = _struct(
    _strings(["COD_SOCIEDAD", "CLASE_DOC", "REFER", "DIV", "TEX_CABECERA",
              "FECHA_CONTAB", "CLAVE_CONTAB", "TERC", "NOM_1", "NOM_2", "POBL", "NIF"])
    + [("NUM_CUENTA", ACCOUNT), ("IMP", MONEY)]
    + _strings(["DIVIS", "C_COSTE", "ASIG", "TEXT", "RAMO_CON", "CANL",
                "INDICADOR_CME", "MODALIDAD_CON"])
)

# Rule and reference tables.
PRODUCT_DIM_RAW = _struct(_strings(["RAMO_POL", "MODALIDAD_POL", "Negocio", "Tipo de Negocio"]))
PRODUCT_DIM = _struct(_strings(["RAMO_POL", "MODALIDAD_POL", "Negocio", "Tipo_de_negocio"]))
EVENT_MASTER = _struct(_strings(["EVENT_NEG"]))
EVENT_RELATION = _struct(_strings(["EVENT_NEG", "COD_ASIENTO"]))
ENTRY_STRUCTURE = _struct(_strings(
    ["COD_SOCIEDAD", "ID_ESTRUCTURA", "COD_ASIENTO", "NOM_IMPORTE", "NATURALEZA"]))
ENTRY_AMOUNTS = _struct(_strings(
    ["COD_SOCIEDAD", "ID_ESTRUCTURA", "COD_ASIENTO", "NOM_IMPORTE", "NOM_CAMPO"]))
ACCOUNT_RULES = _struct(
    _strings(["COD_SOCIEDAD", "ID_CUEN_ASIEN", "ID_ESTRUCTURA", "COD_ASIENTO"])
    + [("NATURALEZA", IntegerType())]
    + _strings(["NOM_CAMPO", "VALOR", "PADRE"])
    + [("COD_CUENTA", ACCOUNT)]
)
CHART_OF_ACCOUNTS = _struct(
    _strings(["ID_MAE_CUENTA", "COD_SOCIEDAD"])
    + [("NUM_CUENTA", ACCOUNT)]
    + _strings(["DESC_CUENTA", "PADRE", "IND_TIPO", "TABLA_AUX", "CAMPO_AUX"])
)

LAYERS = {"RAW": RAW, "F0": F0, "F1": F1, "F2_CONT": POSTINGS, "PS": LEDGER}


class ContractError(ValueError):
    """A frame cannot be projected onto a contract."""


def _converted(source_types: dict, field: StructField) -> Column:
    source = source_types[field.name]
    c = F.col(f"`{field.name}`")
    if source != field.dataType:
        c = c.try_cast(field.dataType)
    return c.alias(field.name)


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Select ``contract``'s columns in order, converting types with ``try_cast``.

    Raises ``ContractError`` naming every missing column; extra columns are
    dropped. This is a pure projection, so Catalyst prunes the scan to the
    contract's columns.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in contract.fields if f.name not in types]
    if missing:
        raise ContractError(f"missing columns for contract: {missing}")
    return df.select([_converted(types, f) for f in contract.fields])


def positional(df: DataFrame, contract: StructType) -> DataFrame:
    """Rename columns by position to the contract's names (header text ignored).

    Raises ``ContractError`` when the column count differs.
    """
    if len(df.columns) != len(contract.fields):
        raise ContractError(
            f"expected {len(contract.fields)} columns, got {len(df.columns)}")
    return df.toDF(*contract.fieldNames())
