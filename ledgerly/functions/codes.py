"""Code-level column functions: status, settlement date, translations, keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerly.functions.common import all_names, column, ident, lit_sql

# The "never happened" date sentinel and receipt status codes.
NEVER = "0001-01"
STATUS_COLLECTED = "CB"
STATUS_RETURNED = "DV"
STATUS_PENDING = "PT"
STATUS_NONE = "NA"

# Mediator types managed directly ("D"); every other type,
# NULL included, is "C".
DIRECT_MEDIATOR_TYPES = ("C", "E", "X")

# Code translations (unlisted codes pass through unchanged).
DOC_TYPE_CODES = {"RPA": "RPRI"}
STATUS_CODES = {"CB": "COB", "DV": "DEV", "PT": "PTE"}
AGENCY_CODES = {"C": "CORR", "E": "ECOL", "X": "AGEX", "L": "SLU", "S": "SLU", "U": "SLU"}


def management_type(mediator_type: Column | str) -> Column:
    if all_names(mediator_type):
        codes = ", ".join(lit_sql(c) for c in DIRECT_MEDIATOR_TYPES)
        return F.expr(f"case when {ident(mediator_type)} in ({codes}) then 'D' else 'C' end")
    return F.when(column(mediator_type).isin(*DIRECT_MEDIATOR_TYPES), F.lit("D")) \
            .otherwise(F.lit("C"))


def receipt_status(charge: Column | str, cancel: Column | str,
                   collect: Column | str) -> Column:
    """Status from three ``YYYY-MM`` texts, compared as strings.

    CB: charge <= collect, cancel <= collect, collected.
    DV: charge <= cancel, cancelled, not collected.
    PT: charged, neither cancelled nor collected.
    Otherwise NA; a NULL in a rule's inputs makes that rule not match.
    """
    if all_names(charge, cancel, collect):
        car, anu, cob, nv = ident(charge), ident(cancel), ident(collect), lit_sql(NEVER)
        return F.expr(
            f"case when {car} <= {cob} and {anu} <= {cob} and {cob} <> {nv} then '{STATUS_COLLECTED}'"
            f" when {car} <= {anu} and {anu} <> {nv} and {cob} = {nv} then '{STATUS_RETURNED}'"
            f" when {car} <> {nv} and {anu} = {nv} and {cob} = {nv} then '{STATUS_PENDING}'"
            f" else '{STATUS_NONE}' end")
    car, anu, cob = column(charge), column(cancel), column(collect)
    return (
        F.when((car <= cob) & (anu <= cob) & (cob != NEVER), F.lit(STATUS_COLLECTED))
        .when((car <= anu) & (anu != NEVER) & (cob == NEVER), F.lit(STATUS_RETURNED))
        .when((car != NEVER) & (anu == NEVER) & (cob == NEVER), F.lit(STATUS_PENDING))
        .otherwise(F.lit(STATUS_NONE))
    )


def settlement_date(status: Column | str, charge: Column | str, cancel: Column | str,
                    collect: Column | str) -> Column:
    """The date that settled the receipt: collect for CB, cancel for DV,
    charge for PT, else ``''``."""
    st = column(status)
    return (
        F.when(st == STATUS_COLLECTED, column(collect))
        .when(st == STATUS_RETURNED, column(cancel))
        .when(st == STATUS_PENDING, column(charge))
        .otherwise(F.lit(""))
    )


def translate_codes(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Map codes through ``mapping``; codes not in it (and NULL) pass through.

    A ``when`` chain keeps the expression inside whole-stage codegen; mappings
    are small fixed code lists.
    """
    if all_names(c) and mapping:
        whens = " ".join(f"when {lit_sql(k)} then {lit_sql(v)}" for k, v in mapping.items())
        return F.expr(f"case {ident(c)} {whens} else {ident(c)} end")
    src = column(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(src == k, F.lit(v)) if expr is None
                else expr.when(src == k, F.lit(v)))
    return src if expr is None else expr.otherwise(src)


def event_key(doc_type: Column | str, status: Column | str) -> Column:
    """Business event name ``<type>_<status>``; NULL parts are skipped."""
    return F.concat_ws("_", column(doc_type), column(status))


def entry_type(entry_code: Column | str) -> Column:
    """Entry type: the first two characters of the entry code."""
    return F.substring(column(entry_code), 1, 2)
