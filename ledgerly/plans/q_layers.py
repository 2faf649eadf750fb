"""Registered queries over the pipeline layers (F0, F1, F2_CONT, PS)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.operators import postings as P
from ledgerly.operators.ledger import ledger, posting_lineage
from ledgerly.plans import oracle as O
from ledgerly.plans.layers import fixture_layers
from ledgerly.plans.registry import SUM_TYPE, count_sql, register


# ---- F0: receipts ----------------------------------------------------------

@register("receipts_normalized", O.with_ctes(f"select {O.F0_COLS} from f0"))
def q_receipts_normalized(spark, sf):
    return fixture_layers(spark, sf).f0


@register("premium_by_status", O.with_ctes(
    "select COD_EST_REC, count(*) as n, "
    f"cast(sum(IMP_PRIM_TARIFA) as {SUM_TYPE}) as premium, "
    f"cast(sum(IMP_TOT_RECIB) as {SUM_TYPE}) as total "
    "from f0 group by COD_EST_REC"))
def q_premium_by_status(spark, sf):
    f0 = fixture_layers(spark, sf).f0
    return f0.groupBy("COD_EST_REC").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("IMP_PRIM_TARIFA").cast(SUM_TYPE).alias("premium"),
        F.sum("IMP_TOT_RECIB").cast(SUM_TYPE).alias("total"))


@register("money_parse", O.with_ctes(
    'select "N.RECIBO" as COD_RECIBO, "IMP.CLEA" as RAW_CLEA, "IMP.ARB." as RAW_ARB, '
    f"{O._m('IMP.CLEA')} as CLEA, {O._m('IMP.ARB.')} as ARB, "
    f"{O._m('IMP.PRIMA')} as PRIMA from raw"))
def q_money_parse(spark, sf):
    from ledgerly.functions import column, money
    raw = fixture_layers(spark, sf).raw
    return raw.select(column("N.RECIBO").alias("COD_RECIBO"),
                      column("IMP.CLEA").alias("RAW_CLEA"),
                      column("IMP.ARB.").alias("RAW_ARB"),
                      money("IMP.CLEA").alias("CLEA"), money("IMP.ARB.").alias("ARB"),
                      money("IMP.PRIMA").alias("PRIMA"))


@register("receipt_status", O.with_ctes(
    "select COD_RECIBO, FEC_EMI, COD_EST_REC, FEC_LIQ from f0"))
def q_receipt_status(spark, sf):
    return fixture_layers(spark, sf).f0.select("COD_RECIBO", "FEC_EMI", "COD_EST_REC",
                                               "FEC_LIQ")


@register("management_type", O.with_ctes(
    count_sql("f0", "COD_AGENCIA", "COD_TIP_GESTION")))
def q_management_type(spark, sf):
    return (fixture_layers(spark, sf).f0.groupBy("COD_AGENCIA", "COD_TIP_GESTION")
            .agg(F.count(F.lit(1)).alias("n")))


@register("settlement_date", O.with_ctes(
    count_sql("f0", "COD_EST_REC", "FEC_LIQ")))
def q_settlement_date(spark, sf):
    return (fixture_layers(spark, sf).f0.groupBy("COD_EST_REC", "FEC_LIQ")
            .agg(F.count(F.lit(1)).alias("n")))


# ---- F1: business events ----------------------------------------------------

_F1_COLS = ", ".join(C.F1.fieldNames())


@register("business_events", O.with_ctes(f"select {_F1_COLS} from f1"))
def q_business_events(spark, sf):
    return fixture_layers(spark, sf).f1


_TRANSLATION_KEYS = ("COD_TIP_RECIB", "TR_COD_TIP_RECIB", "COD_EST_REC",
                     "TR_COD_EST_RECIB", "COD_AGENCIA", "TR_COD_AGENCIA")


@register("code_translation", O.with_ctes(count_sql("f1", *_TRANSLATION_KEYS)))
def q_code_translation(spark, sf):
    return (fixture_layers(spark, sf).f1.groupBy(*_TRANSLATION_KEYS)
            .agg(F.count(F.lit(1)).alias("n")))


_PRODUCT_KEYS = ("COD_RAMO", "COD_MODALIDAD", "TR_NEGOCIO", "TR_COD_TIP_NEGOCIO")


@register("product_enrich", O.with_ctes(count_sql("f1", *_PRODUCT_KEYS)))
def q_product_enrich(spark, sf):
    return (fixture_layers(spark, sf).f1.groupBy(*_PRODUCT_KEYS)
            .agg(F.count(F.lit(1)).alias("n")))


@register("event_ids", O.with_ctes("select TR_ID_EVNEG, COD_RECIBO from f1"))
def q_event_ids(spark, sf):
    return fixture_layers(spark, sf).f1.select("TR_ID_EVNEG", "COD_RECIBO")


@register("event_key", O.with_ctes(count_sql("ev", "EVENT_NEG")))
def q_event_key(spark, sf):
    ev = P.with_event_key(fixture_layers(spark, sf).f1)
    return ev.groupBy("EVENT_NEG").agg(F.count(F.lit(1)).alias("n"))


# ---- F2: postings -----------------------------------------------------------

def _events(spark, sf):
    lay = fixture_layers(spark, sf)
    rules = lay.rules.validate()
    return lay, rules, lay.f1.select(*P.rule_columns(lay.f1, rules))


@register("valid_events", O.with_ctes("select TR_ID_EVNEG, EVENT_NEG from valid"))
def q_valid_events(spark, sf):
    _, rules, ev = _events(spark, sf)
    return P.valid_events(ev, rules).select("TR_ID_EVNEG", "EVENT_NEG")


@register("entry_fanout", O.with_ctes(
    "select TR_ID_EVNEG, EVENT_NEG, COD_ASIENTO from entries"))
def q_entry_fanout(spark, sf):
    _, rules, ev = _events(spark, sf)
    return (P.expand_entries(P.valid_events(ev, rules), rules)
            .select("TR_ID_EVNEG", "EVENT_NEG", "COD_ASIENTO"))


_LINE_COLS = ["TR_ID_EVNEG", "COD_ASIENTO", "ID_ESTRUCTURA", "NOM_IMPORTE", "NATURALEZA",
              "NOM_CAMPO"]


@register("entry_lines", O.with_ctes(f"select {', '.join(_LINE_COLS)} from lines"))
def q_entry_lines(spark, sf):
    _, rules, ev = _events(spark, sf)
    lines = P.expand_lines(P.expand_entries(P.valid_events(ev, rules), rules), rules)
    return lines.select(*_LINE_COLS)


_MATCH_COLS = _LINE_COLS + ["COD_CUENTA", "DESC_CUENTA", "IND_TIPO", "CAMPO_AUX"]
_MATCH_SQL = O.with_ctes(f"select {', '.join(_MATCH_COLS)} from matched")


@register("account_rule_match", _MATCH_SQL)
def q_account_rule_match(spark, sf):
    lay = fixture_layers(spark, sf)
    return P.matched_lines(lay.f1, lay.rules.validate()).select(*_MATCH_COLS)


@register("account_rule_match_pivot", _MATCH_SQL)
def q_account_rule_match_pivot(spark, sf):
    from ledgerly.operators.rules_pivot import match_rules_pivot
    _, rules, ev = _events(spark, sf)
    lines = P.expand_lines(P.expand_entries(P.valid_events(ev, rules), rules), rules)
    return match_rules_pivot(lines, rules).select(*_MATCH_COLS)


_POSTING_COLS = ", ".join(C.POSTINGS.fieldNames())


@register("postings", O.with_ctes(f"select {_POSTING_COLS} from postings"))
def q_postings(spark, sf):
    return fixture_layers(spark, sf).postings


@register("posting_amount_pick", O.with_ctes(
    "select TR_ID_EVNEG, TR_ID_EVCON, TR_NAT_EVCON, TR_CUENTA_CONT, TR_CC_IMP from postings"))
def q_posting_amount_pick(spark, sf):
    return fixture_layers(spark, sf).postings.select(
        "TR_ID_EVNEG", "TR_ID_EVCON", "TR_NAT_EVCON", "TR_CUENTA_CONT", "TR_CC_IMP")


@register("posting_description", O.with_ctes(
    count_sql("postings", "TR_CUENTA_CONT", "TR_CC_DES")))
def q_posting_description(spark, sf):
    return (fixture_layers(spark, sf).postings.groupBy("TR_CUENTA_CONT", "TR_CC_DES")
            .agg(F.count(F.lit(1)).alias("n")))


@register("posting_attributes", O.with_ctes(
    count_sql("postings", "TR_COD_TIP_EVCON", "TR_ID_EVCON", "TR_NAT_EVCON")))
def q_posting_attributes(spark, sf):
    return (fixture_layers(spark, sf).postings
            .groupBy("TR_COD_TIP_EVCON", "TR_ID_EVCON", "TR_NAT_EVCON")
            .agg(F.count(F.lit(1)).alias("n")))


@register("nature_filter", O.with_ctes(
    f"select {_POSTING_COLS} from postings where try_cast(TR_NAT_EVCON as integer) = 1"))
def q_nature_filter(spark, sf):
    from ledgerly.operators.filters import by_nature
    return by_nature(fixture_layers(spark, sf).postings, 1)


# ---- PS: ledger ---------------------------------------------------------------

_LEDGER_COLS = ", ".join(C.LEDGER.fieldNames())
_LEDGER_SQL = O.with_ctes(f"select {_LEDGER_COLS} from ps", {"ps": O.ledger_select()})


@register("ledger_summary", _LEDGER_SQL)
def q_ledger_summary(spark, sf):
    return fixture_layers(spark, sf).ledger


@register("ledger_from_layers", _LEDGER_SQL)
def q_ledger_from_layers(spark, sf):
    lay = fixture_layers(spark, sf)
    return ledger(lay.postings, lay.f1, lay.posting_date)


_LINEAGE_COLS = ["TR_ID_EVNEG", "TR_COD_TIP_EVCON", "TR_ID_EVCON", "TR_NAT_EVCON",
                 "TR_CUENTA_CONT", "TR_CC_IMP", "TR_COD_RAMO_CONT", "TR_COD_MOD_CONT",
                 "COD_SOCIEDAD", "COD_DIVISA", "CON_LIQUIDACION", "COD_MEDIADOR",
                 "TR_COD_AGENCIA"]


@register("posting_lineage", O.with_ctes(
    f"select p.{', p.'.join(_LINEAGE_COLS[:8])}, e.COD_SOCIEDAD, e.COD_DIVISA, "
    "e.CON_LIQUIDACION, e.COD_MEDIADOR, e.TR_COD_AGENCIA "
    "from postings p join f1 e on p.TR_ID_EVNEG = e.TR_ID_EVNEG"))
def q_posting_lineage(spark, sf):
    lay = fixture_layers(spark, sf)
    return posting_lineage(lay.postings, lay.f1).select(*_LINEAGE_COLS)
