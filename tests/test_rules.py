"""Account-rule edge cases and the single-join vs pivot/union equivalence."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.functions import UnknownColumnError
from ledgerly.operators import postings as P
from ledgerly.operators.enrich import business_events, product_dimension
from ledgerly.operators.rejects import unmatched_events, with_rule_counts
from ledgerly.operators.rules import RuleError, RuleSet
from ledgerly.operators.rules_pivot import match_rules_pivot
from ledgerly.sources import fixtures as FX

EVENT_COLS = ("TR_ID_EVNEG string, COD_SOCIEDAD string, COD_RAMO string, "
              "TR_COD_TIP_RECIB string, TR_COD_EST_RECIB string, TR_NEGOCIO string, "
              "TR_COD_TIP_NEGOCIO string, TR_COD_RAMO_CONT string, TR_COD_MOD_CONT string, "
              "TR_COD_AGENCIA string, COD_MEDIADOR string, IMP_PRIM_TARIFA decimal(13,2), "
              "IPS decimal(13,2)")


def events(spark, rows):
    """rows: (id, ramo, agency, mediator)."""
    data = [(i, "SSL1", ramo, "RPRI", "COB", None, None, "C1", "M1", ag, med,
             Decimal("100.00"), Decimal("7.00")) for i, ramo, ag, med in rows]
    return spark.createDataFrame(data, EVENT_COLS)


def rules_with(spark, account_rows=None, chart=None, **over):
    tabs = {k: spark.sql(FX.values_sql(v, FX.FIXTURE_SCHEMAS[k]))
            for k, v in FX.fixture_rows().items()}
    if account_rows is not None:
        tabs["account_rules"] = spark.createDataFrame(account_rows, C.ACCOUNT_RULES)
    if chart is not None:
        tabs["chart_of_accounts"] = spark.createDataFrame(chart, C.CHART_OF_ACCOUNTS)
    tabs.update(over)
    return RuleSet.from_tables(tabs)


def acct(rule_id, nature, name, value, account, entry="CB01"):
    return ("SSL1", rule_id, f"{entry}-E", entry, nature, name, value, None,
            None if account is None else Decimal(account))


def chart_row(num, desc="D", kind="0", aux=None, company="SSL1"):
    return (f"M{num}", company, Decimal(num), desc, None, kind, None, aux)


def lines(ev, rules):
    return P.expand_lines(P.expand_entries(P.valid_events(ev, rules), rules), rules)


def test_two_attributes_on_one_rule_give_two_postings(spark):
    rules = rules_with(spark, [acct("r1", 1, "COD_RAMO", "01", 1),
                               acct("r1", 1, "TR_COD_AGENCIA", "CORR", 1)],
                       chart=[chart_row(1)])
    ev = events(spark, [("e1", "01", "CORR", "9"), ("e2", "01", "SLU", "9")])
    m = P.match_rules(lines(ev, rules), rules)
    counts = {r.TR_ID_EVNEG: r["count"] for r in m.groupBy("TR_ID_EVNEG").count().collect()}
    assert counts == {"e1": 2, "e2": 1}   # nature-1 PRIMA line of CB01 only


def test_duplicate_cell_keeps_min_and_null_value_dropped(spark):
    rules = rules_with(spark, [acct("r1", 1, "COD_RAMO", "04", 1),
                               acct("r1", 1, "COD_RAMO", "01", 1),
                               acct("r2", 1, "COD_RAMO", None, 2)],
                       chart=[chart_row(1), chart_row(2)])
    cells = rules.account_cells().collect()
    assert [(c.ID_CUEN_ASIEN, c.VALOR) for c in cells] == [("r1", "01")]


def test_null_attribute_name_rejected(spark):
    rules = rules_with(spark, [acct("r1", 1, None, "01", 1)], chart=[chart_row(1)])
    with pytest.raises(RuleError):
        rules.validate()


def test_unknown_column_rejected(spark):
    rules = rules_with(spark, [acct("r1", 1, "NOT_A_COLUMN", "01", 1)],
                       chart=[chart_row(1)])
    with pytest.raises(UnknownColumnError):
        P.postings(events(spark, [("e1", "01", "CORR", "9")]), rules)


def test_repeated_master_key_rejected(spark):
    master = spark.createDataFrame([("RPRI_COB",), ("RPRI_COB",)], C.EVENT_MASTER)
    with pytest.raises(RuleError):
        rules_with(spark, event_master=master).validate()


def test_chart_in_two_companies_multiplies(spark):
    rules = rules_with(spark, [acct("r1", 1, "COD_RAMO", "01", 1)],
                       chart=[chart_row(1), chart_row(1, company="OTRA")])
    ev = events(spark, [("e1", "01", "CORR", "9")])
    assert P.match_rules(lines(ev, rules), rules).count() == 2


@pytest.mark.parametrize("kind,aux,ok", [("1", "COD_MEDIADOR", True), ("0", None, True),
                                          (None, None, False), ("x", None, False),
                                          ("1", None, False)])
def test_bad_descriptions_go_to_rejects(spark, kind, aux, ok):
    rules = rules_with(spark, [acct("r1", 1, "COD_RAMO", "01", 1)],
                       chart=[chart_row(1, desc="Deud", kind=kind, aux=aux)])
    ev = events(spark, [("e1", "01", "CORR", "42")])
    posts = P.postings(ev, rules).collect()
    rej = unmatched_events(ev, rules).filter(F.col("REASON") == "bad_account_description")
    assert (len(posts), rej.count()) == ((1, 0) if ok else (0, 1))
    if ok and kind == "1":
        assert posts[0].TR_CC_DES == "Deud - 42"


def test_dimension_with_repeated_key_fans_out_with_unique_ids(spark, layers):
    dim_raw = spark.createDataFrame([("1", "0", "A", "X"), ("01", "00", "B", "Y")],
                                    C.PRODUCT_DIM_RAW)
    f0 = layers.f0.filter((F.col("COD_RAMO") == "01") & (F.col("COD_MODALIDAD") == "000"))
    n = f0.count()
    f1 = business_events(f0, product_dimension(dim_raw))
    assert f1.count() == 2 * n
    assert f1.select("TR_ID_EVNEG").distinct().count() == 2 * n


def test_reject_reasons_cover_every_event(layers):
    """Every event either posts at least once or appears in the rejects."""
    rules = layers.rules.validate()
    rej = unmatched_events(layers.f1, rules)
    posted = layers.postings.select("TR_ID_EVNEG").distinct()
    rejected_events = rej.filter(F.col("REASON").isin("invalid_event", "no_entry"))
    both = posted.join(rejected_events.select("TR_ID_EVNEG"), "TR_ID_EVNEG", "inner")
    assert both.count() == 0
    all_ids = posted.union(rej.select("TR_ID_EVNEG")).distinct().count()
    assert all_ids == layers.f1.count()


cell = st.tuples(st.sampled_from(["r1", "r2", "r3"]), st.sampled_from([1, 2]),
                 st.sampled_from(["COD_RAMO", "TR_COD_AGENCIA"]),
                 st.sampled_from(["01", "04", "CORR", "SLU", None]),
                 st.sampled_from([1, 2, None]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(cell, min_size=1, max_size=8))
def test_single_join_equals_pivot_union(spark, cells):
    rows = [acct(rid, nat, name, val, account) for rid, nat, name, val, account in cells]
    rules = rules_with(spark, rows, chart=[chart_row(1), chart_row(2)])
    ev = events(spark, [("e1", "01", "CORR", "1"), ("e2", "04", "SLU", "2"),
                        ("e3", "02", "ECOL", "3")])
    ln = lines(ev, rules)
    a = P.match_rules(ln, rules)
    b = match_rules_pivot(ln, rules).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_shuffle_path_equals_broadcast_path(spark, layers):
    """Rule frames over the broadcast bound join by shuffle; same postings."""
    tabs = {k: spark.sql(FX.values_sql(v, FX.FIXTURE_SCHEMAS[k]))
            for k, v in FX.fixture_rows().items()}
    shuffled = RuleSet.from_tables(tabs, max_broadcast_rows=0).validate()
    assert all(v > 0 for v in shuffled.sizes().values())
    a = P.postings(layers.f1, shuffled)
    b = layers.postings
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reject_reasons_no_entry_and_no_structure(spark):
    """An event name in the master without an entry, and an entry without
    structure lines, are reported at event and entry grain."""
    master = spark.createDataFrame([("RPRI_COB",), ("RPRI_PTE",)], C.EVENT_MASTER)
    relation = spark.createDataFrame([("RPRI_COB", "CB01"), ("RPRI_COB", "ZZ99")],
                                     C.EVENT_RELATION)
    rules = rules_with(spark, [acct("r1", 1, "COD_RAMO", "01", 1)], chart=[chart_row(1)],
                       event_master=master, event_relation=relation)
    ev = events(spark, [("e1", "01", "CORR", "9")])
    pte = ev.withColumn("TR_ID_EVNEG", F.lit("e2")).withColumn("TR_COD_EST_RECIB", F.lit("PTE"))
    dev = ev.withColumn("TR_ID_EVNEG", F.lit("e3")).withColumn("TR_COD_EST_RECIB", F.lit("DEV"))
    rej = unmatched_events(ev.unionByName(pte).unionByName(dev), rules)
    got = sorted((r.TR_ID_EVNEG, r.REASON, r.COD_ASIENTO, r.NATURALEZA) for r in rej.collect())
    assert ("e1", "no_structure", "ZZ99", None) in got
    assert ("e2", "no_entry", None, None) in got
    assert ("e3", "invalid_event", None, None) in got
    # CB01 lines of e1: nature-1 PRIMA matches the rule; the nature-2 lines do not
    assert sorted(g for g in got if g[1] == "no_account_rule") == [
        ("e1", "no_account_rule", "CB01", "2"), ("e1", "no_account_rule", "CB01", "2")]
    assert P.postings(ev, rules).count() == 1


def test_master_of_any_size(spark):
    names = spark.range(10_001).selectExpr("concat('E', cast(id as string)) as EVENT_NEG")
    rules = rules_with(spark, event_master=names)
    assert rules.validate().sizes()["valid_events"] == 10_001
    with pytest.raises(RuleError):
        rules_with(spark, event_master=names.unionAll(names.limit(1))).validate()


def test_decimal_attribute_matches_in_its_own_type(spark):
    rows = [("SSL1", "r", "CB01-E", "CB01", 1, "IMP_PRIM_TARIFA", v, None, Decimal(7000000001))
            for v in ("100", "100.000", "100.0049", "x", None)]
    ev = events(spark, [("e1", "04", "CORR", "M")])
    got = P.match_rules(lines(ev, rules_with(spark, account_rows=rows)), rules_with(spark, account_rows=rows))
    pivot = match_rules_pivot(lines(ev, rules_with(spark, account_rows=rows)),
                              rules_with(spark, account_rows=rows))
    assert got.count() == pivot.count()


def test_unmatched_lines_are_those_without_a_rule(spark):
    rules = rules_with(spark)
    ln = lines(events(spark, [("e1", "04", "CORR", "M"), ("e2", "99", "NONE", "M"), ("e3", None, None, "M")]),
               rules)
    matched = {r.TR_ID_EVNEG for r in P.match_rules(ln, rules).collect()}
    unmatched = {r.TR_ID_EVNEG for r in with_rule_counts(ln, rules).where("_RULES = 0").collect()}
    assert matched == {"e1"} and unmatched == {"e2", "e3"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reject_report_is_one_pass(spark):
    rules = rules_with(spark).validate()
    ev = events(spark, [("e1", "04", "CORR", "M"), ("e2", "99", "NONE", "M")]).repartition(3)
    plan = plan_of(unmatched_events(ev, rules))
    events_side = [line for line in plan.splitlines() if "BroadcastHashJoin" in line or "SortMergeJoin" in line]
    assert "Union" not in plan
    # master, relation, structure (with its own inner join), one per attribute, and the chart
    assert len(events_side) <= 4 + 2 * len(rules.names()["attributes"])


def test_lines_that_match_twice_and_bad_accounts(spark):
    rows = [("SSL1", "r1", "CB01-E", "CB01", 1, "COD_RAMO", "04", None, Decimal(7000000001)),
            ("SSL1", "r2", "CB01-E", "CB01", 1, "TR_COD_AGENCIA", "CORR", None, Decimal(7000000009))]
    rules = rules_with(spark, account_rows=rows)
    ln = lines(events(spark, [("e1", "04", "CORR", "M")]), rules)
    matched = P.match_rules(ln, rules)
    counted = with_rule_counts(ln, rules).agg(F.sum("_RULES"), F.sum("_BAD")).first()
    assert counted[0] == matched.count()
    assert counted[1] == matched.where(~P.describable_account()).count()


def test_broadcast_bound_in_bytes(spark):
    wide = spark.createDataFrame([("E" * 5000,), ("F" * 5000,)], "EVENT_NEG string")
    rules = rules_with(spark, event_master=wide).validate()
    assert rules.is_small("valid_events")
    rules = rules_with(spark, event_master=wide)
    rules.max_broadcast_bytes = 9000
    assert not rules.validate().is_small("valid_events")
