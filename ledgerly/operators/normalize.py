"""Raw receipt extract -> F0 typed receipts (one projection, no shuffle)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.functions import (
    column,
    management_type,
    money,
    receipt_status,
    settlement_date,
)
from ledgerly.session import compiled_methods

# Constant F0 fields of the receipt layer.
RECEIPT_DEFAULTS = {
    "COD_SOCIEDAD": "SSL1",
    "COD_GARANTIA": "",
    "COD_CERTIFICADO": "",
    "MAR_NUEV_RECIBO": "N",
    "COD_DIVISA": "EUR",
    "IMP_PRIM_PERIOD": Decimal(0),
    "IMP_PRIM_EXTOR_EJER": Decimal(0),
    "IMP_PRIM_EXTOR_EJER_ANT": Decimal(0),
    "IMP_PRIM_ANUL_EJER_ANT": Decimal(0),
    "TAS_CSS_PRIM_PEND_COBR": Decimal(0),
    "IMP_RETEN_FISC": Decimal(0),
    "ID_MOV_ECON": "",
    "REC_FRACCIONADO": "N",
    "MAR_RECIB_SIMUL": "N",
    "COMP": "N",
    "MAR_REINV": "N",
    "ENT_COLABORADORA": "",
    "COD_TIP_SIN": "",
    "IMP_COA": Decimal(0),
    "PRE_RECOBRADAS": Decimal(0),
    "NOM_DESTINATARIO": "Nombre Tomador 1",
    "NOM_POBL": "Comunidad de Madrid",
    "NIF": "11223344A",
    "CTA_BANC": "01112222330011223344",
    "ENT_BANCARIA": "Banco A",
    "COD_EST_REC_ANT": "",
}

# F0 field <- raw field, copied as text.
RENAMES = {
    "COD_POLIZA": "POLIZA",
    "COD_RAMO": "RAMO",
    "COD_MODALIDAD": "MODALIDAD",
    "COD_RECIBO": "N.RECIBO",
    "FEC_MOV_ECON": "F.EFECTO",
    "FEC_EMI": "F.LIQ.CAR.",
    "COD_TIP_RECIB": "TIPO_DOC.",
    "COD_AGENCIA": "T.MEDIADOR",
    "COD_MEDIADOR": "MEDIADOR",
    "CON_LIQUIDACION": "C.LIQUIDACION",
    "TR_COD_RAMO_CONT": "RAMO_CONT.",
    "TR_COD_MOD_CONT": "MODALI.CONT.",
}

# F0 money field <- raw decimal-comma text.
MONEY_FIELDS = {
    "IMP_PRIM_TARIFA": "IMP.PRIMA",
    "IMP_PRIM_UNIC": "IMP.PRIMA",
    "BON_N_SINIESTRALIDAD": "IMP.BONIFIC.",
    "IPS": "IMP.IPS",
    "TAS_CSS_REC_RIES_EXTR": "IMP.CONSORC.",
    "TAS_CSS_REC_FUN_LIQ": "IMP.CLEA",
    "ARB_BOMBEROS": "IMP.ARB.",
    "IMP_COMISIONES": "IMP.COMI.",
    "IMP_TOT_RECIB": "IMP.RECIBO",
    "CAR_RECIB": "IMP.RECIBO",
    "IMP_DESCUENTO": "IMP.DTO.RECIBO",
    "IMP_PRIM_REAL": "IMP.RECIBO",
}


def receipt_columns() -> dict[str, Column]:
    """F0 field -> expression over raw fields (canonical raw names)."""
    charge, cancel, collect = "F.LIQ.CAR.", "F.LIQ.ANU.", "F.LIQ.COB."
    status = receipt_status(charge, cancel, collect)
    exprs: dict[str, Column] = {}
    for name, value in RECEIPT_DEFAULTS.items():
        exprs[name] = F.lit(value)
    for name, src in RENAMES.items():
        exprs[name] = column(src)
    for name, src in MONEY_FIELDS.items():
        exprs[name] = money(src)
    exprs["COD_TIP_GESTION"] = management_type("T.MEDIADOR")
    exprs["COD_EST_REC"] = status
    exprs["FEC_LIQ"] = settlement_date(status, charge, cancel, collect)
    return exprs


def normalize_receipts(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw 27-field extract -> F0 contract (53 columns, typed).

    Fields are taken by position, so header spellings do not matter.
    ``keep`` passes extra input columns (e.g. provenance) through unchanged.
    """
    compiled_methods(raw.sparkSession)
    keep = list(keep or [])
    fields = [c for c in raw.columns if c not in keep]
    if len(fields) != len(C.RAW_NAMES):
        raise C.ContractError(
            f"expected {len(C.RAW_NAMES)} receipt fields, got {len(fields)}")
    base = raw.select(*[column(c).alias(n) for c, n in zip(fields, C.RAW_NAMES)],
                      *[column(k) for k in keep])
    exprs = receipt_columns()
    cols = [exprs[f.name].cast(f.dataType).alias(f.name) for f in C.F0.fields]
    return base.select(*cols, *[column(k) for k in keep])
