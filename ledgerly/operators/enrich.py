"""F0 receipts -> F1 business events.

Code translations are projections; the product dimension is a left join on
integer-normalised keys (``'01'`` equals ``'1'``) against a size-checked
broadcast, so the event side is never shuffled; a dimension beyond the bounds is
joined by a salted shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.functions import (
    AGENCY_CODES,
    DOC_TYPE_CODES,
    STATUS_CODES,
    event_id,
    translate_codes,
)
from ledgerly.operators.rules import DEFAULT_MAX_BROADCAST_ROWS, is_small
from ledgerly.operators.skew import salted_join

# The used columns of the product table.
DIM_COLUMNS = ["RAMO_POL", "MODALIDAD_POL", "Negocio", "Tipo de Negocio"]

# The receipt's natural key, the columns the ledger joins back by
# id, then the matched product row. Rows that share an id agree in every joined
# column, so the join-form ledger may keep any one of them, even where two
# receipts share a number. Leaving out the other F0 columns keeps the id
# prunable: postings and ledgers never compute columns they do not use.
EVENT_ID_PARTS = ["COD_SOCIEDAD", "COD_RECIBO", "COD_DIVISA", "CON_LIQUIDACION",
                  "COD_MEDIADOR", "COD_AGENCIA", "_DIM_RAMO", "_DIM_MODALIDAD",
                  "TR_NEGOCIO", "TR_COD_TIP_NEGOCIO"]


def product_dimension(raw_dim: DataFrame) -> DataFrame:
    """Reference CSV -> product dimension: the four used columns, distinct,
    ``Tipo de Negocio`` renamed ``Tipo_de_negocio``, NULL text -> ``''``.

    Column names match case-insensitively, as Spark resolves them.
    """
    lower = {c.lower(): c for c in raw_dim.columns}
    picked = []
    for want in DIM_COLUMNS:
        have = lower.get(want.lower())
        if have is None:
            raise C.ContractError(f"product dimension lacks column {want!r}")
        picked.append(F.col(f"`{have}`").cast("string").alias(want))
    dim = raw_dim.select(*picked).distinct()
    return dim.withColumnRenamed("Tipo de Negocio", "Tipo_de_negocio").na.fill("")


def translate_receipt_codes(f0: DataFrame) -> DataFrame:
    return f0.withColumns({
        "TR_COD_TIP_RECIB": translate_codes("COD_TIP_RECIB", DOC_TYPE_CODES),
        "TR_COD_EST_RECIB": translate_codes("COD_EST_REC", STATUS_CODES),
        "TR_COD_AGENCIA": translate_codes("COD_AGENCIA", AGENCY_CODES),
    })


def enrich_product(events: DataFrame, dim: DataFrame,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join to the product dimension; misses give NULL business codes.

    Adds ``TR_NEGOCIO``, ``TR_COD_TIP_NEGOCIO`` and the matched dimension row
    (``_DIM_*``) so that a dimension with a repeated normalised key, which fans
    an event out, still yields distinct event ids.
    """
    d = dim.select(
        F.col("RAMO_POL").alias("_DIM_RAMO"),
        F.col("MODALIDAD_POL").alias("_DIM_MODALIDAD"),
        F.col("Negocio").alias("TR_NEGOCIO"),
        F.col("Tipo_de_negocio").alias("TR_COD_TIP_NEGOCIO"),
    )
    keyed = events.withColumns({"_RAMO": events.COD_RAMO.try_cast("int"),
                                "_MODALIDAD": events.COD_MODALIDAD.try_cast("int")})
    d = d.withColumns({"_RAMO": F.col("_DIM_RAMO").try_cast("int"),
                       "_MODALIDAD": F.col("_DIM_MODALIDAD").try_cast("int")})
    keys = ["_RAMO", "_MODALIDAD"]
    if is_small(d, max_broadcast_rows):
        joined = keyed.join(F.broadcast(d), keys, "left")
    elif events.isStreaming:  # keys of a stream cannot be counted beforehand
        joined = keyed.join(d, keys, "left")
    else:
        joined = salted_join(keyed, d, keys, ["COD_RECIBO"], "left")
    return joined.drop(*keys)


def business_events(f0: DataFrame, dim: DataFrame,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    keep: list[str] = ()) -> DataFrame:
    """F0 -> F1 (59 columns): translations, product enrichment, event id.

    The id hashes the receipt number, the event columns that the ledger joins
    back, and the matched dimension row: reruns, retries after executor loss
    and streaming all give the same id, and a dimension with a repeated
    normalised key still yields distinct ids. Rows that share an id (a line
    delivered twice, or two receipts of one number that differ only in other
    columns) are alike in all the ledger joins back, so the join-form ledger
    posts each of them, like the fused ledger.
    ``keep`` passes extra input columns (e.g. a change type) through.
    """
    ev = enrich_product(translate_receipt_codes(f0), dim, max_broadcast_rows)
    ev = ev.withColumn("TR_ID_EVNEG", event_id(*EVENT_ID_PARTS))
    out = C.conform(ev, C.F1)
    if keep:
        out = ev.select(*out.columns, *keep)
    return out
