"""Registered queries: reject report, controls, sampling, snapshots, upserts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerly import contracts as C
from ledgerly.operators.changes import snapshot_changes, upsert
from ledgerly.operators.counts import layer_counts, receipt_key_profile
from ledgerly.operators.filters import LIFE_LINES, NON_LIFE_LINES, by_event, line_filter
from ledgerly.operators.ledger import ledger
from ledgerly.operators.normalize import normalize_receipts
from ledgerly.operators.postings import matched_lines, postings
from ledgerly.operators.rejects import REJECT_COLUMNS, unmatched_events
from ledgerly.operators.sampling import CASE_COLUMN, case_sample
from ledgerly.plans import oracle as O
from ledgerly.plans.layers import fixture_layers, publish_layers
from ledgerly.plans.registry import register
from ledgerly.session import scratch_path
from ledgerly.sinks import full_refresh
from ledgerly.sources import fixtures as FX
from ledgerly.sources.tables import load_table, receipts_as_of
from ledgerly.versions import KeyedTable

_NULL = "cast(null as varchar)"


def reject_select() -> str:
    """The reject report as one select over the layers' CTEs."""
    ev_cols = f"TR_ID_EVNEG, EVENT_NEG, {_NULL} as COD_ASIENTO, {_NULL} as ID_ESTRUCTURA, " \
              f"{_NULL} as NOM_IMPORTE, {_NULL} as NATURALEZA"
    line_cols = "TR_ID_EVNEG, EVENT_NEG, COD_ASIENTO, ID_ESTRUCTURA, NOM_IMPORTE, NATURALEZA"
    line_keys = ["TR_ID_EVNEG", "COD_ASIENTO", "ID_ESTRUCTURA", "NOM_IMPORTE", "NATURALEZA"]
    same_line = " and ".join(f"m.{k} = l.{k}" for k in line_keys)
    of = lambda alias, cols: ", ".join(f"{alias}.{c}" for c in cols.split(", "))
    ev_of = lambda alias: ev_cols.replace("TR_ID_EVNEG, EVENT_NEG", of(alias, "TR_ID_EVNEG, EVENT_NEG"))
    return f"""
select {ev_of('e')}, 'invalid_event' as REASON from ev e
 left join event_master m on m.EVENT_NEG = e.EVENT_NEG where m.EVENT_NEG is null
union all
select {ev_of('v')}, 'no_entry' from valid v
 left join (select distinct EVENT_NEG from event_relation) r on r.EVENT_NEG = v.EVENT_NEG
 where r.EVENT_NEG is null
union all
select e.TR_ID_EVNEG, e.EVENT_NEG, e.COD_ASIENTO, {_NULL}, {_NULL}, {_NULL}, 'no_structure' from entries e
 left join (select distinct COD_ASIENTO, COD_SOCIEDAD from amount_structure) s
  on s.COD_ASIENTO = e.COD_ASIENTO and s.COD_SOCIEDAD = e.COD_SOCIEDAD where s.COD_ASIENTO is null
union all
select {of('l', line_cols)}, 'no_account_rule' from lines l
 left join (select distinct {', '.join(line_keys)} from matched) m on {same_line}
 where m.TR_ID_EVNEG is null
union all
select {line_cols}, 'bad_account_description' from matched where not ({O.DESCRIBABLE})"""


def reject_sql(extra: dict[str, str] | None = None) -> str:
    return O.with_ctes(reject_select(), extra)


@register("unmatched_events", reject_sql())
def q_unmatched_events(spark, sf):
    lay = fixture_layers(spark, sf)
    return unmatched_events(lay.f1, lay.rules.validate()).select(*REJECT_COLUMNS)


# Rule tables with a gap of each kind: an event without an entry, an entry
# without a structure, an account whose kind is no integer.
_GAPS = {
    "event_relation": "EVENT_NEG <> 'RSUP_PTE'",
    "entry_structure": "COD_ASIENTO <> 'DV01'",
}
_BAD_ACCOUNT = 7000000002


def _gap_rules(rules):
    chart = rules.chart_of_accounts.withColumn("IND_TIPO", F.when(
        F.col("NUM_CUENTA") == _BAD_ACCOUNT, "x").otherwise(F.col("IND_TIPO")))
    return replace(rules, _sizes=None, _names=None, _dups=None, chart_of_accounts=chart,
                   **{k: getattr(rules, k).where(v) for k, v in _GAPS.items()})


def _gap_ctes() -> dict[str, str]:
    own = O.base_ctes()
    out = {k: f"select * from ({own[k]}) where {v}" for k, v in _GAPS.items()}
    out["chart_of_accounts"] = f"""select * replace (case when NUM_CUENTA = {_BAD_ACCOUNT}
 then 'x' else IND_TIPO end as IND_TIPO) from ({own['chart_of_accounts']})"""
    return out


@register("reject_reasons", reject_sql(_gap_ctes()))
def q_reject_reasons(spark, sf):
    """The reject report under rules with gaps: every reason has rows."""
    lay = fixture_layers(spark, sf)
    return unmatched_events(lay.f1, _gap_rules(lay.rules).validate()).select(*REJECT_COLUMNS)


# Account rules out of the suppliers: the account of every entry line follows
# the mediator (text) or the receipt's amount of commission (a decimal, written
# without its decimals in the rules).
def _supplier_rules_sql() -> str:
    entries = " union all ".join(
        f"select '{e}' as COD_ASIENTO, '{FX.structure_id(e)}' as ID_ESTRUCTURA" for e in FX.ENTRIES)
    cells = """select 'COD_MEDIADOR' as NOM_CAMPO, cast(s_suppkey as {text}) as VALOR,
  cast(4000000000 + s_suppkey as decimal(10,0)) as COD_CUENTA from supplier
 union all select distinct 'IMP_COMISIONES', cast(1 + s_suppkey % 50 as {text}),
  cast(4100000000 + s_suppkey % 50 as decimal(10,0)) from supplier"""
    return f"""select '{FX.COMPANY}' as COD_SOCIEDAD, concat_ws('-', NOM_CAMPO, VALOR) as ID_CUEN_ASIEN,
 ID_ESTRUCTURA, COD_ASIENTO, n as NATURALEZA, NOM_CAMPO, VALOR, cast(null as {{text}}) as PADRE, COD_CUENTA
from ({cells}) c, ({entries}) e, (select 1 as n union all select 2) n"""


_SUPPLIER_CHART_SQL = f"""select concat('K', cast(COD_CUENTA as {{text}})) as ID_MAE_CUENTA,
 '{FX.COMPANY}' as COD_SOCIEDAD, COD_CUENTA as NUM_CUENTA, concat('Cuenta ', cast(COD_CUENTA as {{text}})) as DESC_CUENTA,
 cast(null as {{text}}) as PADRE, '0' as IND_TIPO, cast(null as {{text}}) as TABLA_AUX,
 cast(null as {{text}}) as CAMPO_AUX
from (select distinct COD_CUENTA from account_rules)"""


def _supplier_match_sql() -> str:
    rules = _supplier_rules_sql().format(text="varchar")
    return O.with_ctes("""select l.TR_ID_EVNEG, l.COD_ASIENTO, l.NOM_IMPORTE, l.NATURALEZA, r.COD_CUENTA,
 c.DESC_CUENTA
from lines l join account_rules r on l.COD_SOCIEDAD = r.COD_SOCIEDAD and l.ID_ESTRUCTURA = r.ID_ESTRUCTURA
 and l.COD_ASIENTO = r.COD_ASIENTO and try_cast(l.NATURALEZA as integer) = r.NATURALEZA
 and ((r.NOM_CAMPO = 'COD_MEDIADOR' and l.COD_MEDIADOR = r.VALOR)
   or (r.NOM_CAMPO = 'IMP_COMISIONES' and l.IMP_COMISIONES = try_cast(r.VALOR as decimal(13,2))))
join chart_of_accounts c on r.COD_CUENTA = c.NUM_CUENTA""",
        {"account_rules": rules, "chart_of_accounts": _SUPPLIER_CHART_SQL.format(text="varchar")})


@register("supplier_account_rules", _supplier_match_sql())
def q_supplier_account_rules(spark, sf):
    """Account-rule match with rules that grow with the suppliers, on a text
    and on a decimal attribute."""
    lay = fixture_layers(spark, sf)
    load_table(spark, sf, "supplier").createOrReplaceTempView("supplier")
    account_rules = C.conform(spark.sql(_supplier_rules_sql().format(text="string")), C.ACCOUNT_RULES)
    account_rules.createOrReplaceTempView("account_rules")
    chart = C.conform(spark.sql(_SUPPLIER_CHART_SQL.format(text="string")), C.CHART_OF_ACCOUNTS)
    rules = replace(lay.rules, _sizes=None, _names=None, _dups=None, account_rules=account_rules,
                    chart_of_accounts=chart)
    return matched_lines(lay.f1, rules).select("TR_ID_EVNEG", "COD_ASIENTO", "NOM_IMPORTE",
                                               "NATURALEZA", "COD_CUENTA", "DESC_CUENTA")


# The lines of one order as receipts of one number: they differ in mediator.
_REUSED_SQL = 'select * replace ("POLIZA" as "N.RECIBO") from raw_all'
_REUSED_LEDGER = O.with_ctes(f"select {', '.join(C.LEDGER.fieldNames())} from ps", {
    "ps": O.ledger_select("wide_postings", "(select null as TR_ID_EVNEG)").replace(
        "select p.*, e.COD_SOCIEDAD, e.COD_DIVISA, e.CON_LIQUIDACION, e.COD_MEDIADOR, e.TR_COD_AGENCIA",
        "select p.*").replace("p join (select null as TR_ID_EVNEG) e using (TR_ID_EVNEG)", "p"),
}, raw=_REUSED_SQL).replace("ps as (", f"""wide_postings as (select {O._posting_cols()},
 COD_SOCIEDAD, COD_DIVISA, CON_LIQUIDACION, COD_MEDIADOR, TR_COD_AGENCIA
 from matched where {O.DESCRIBABLE}),
ps as (""", 1)


@register("ledger_reused_numbers", _REUSED_LEDGER)
def q_ledger_reused_numbers(spark, sf):
    """The join-form ledger over receipts of which several share a number."""
    lay = fixture_layers(spark, sf)
    reused = replace(lay, raw=lay.raw.withColumn("N.RECIBO", F.col("POLIZA")))
    return ledger(reused.postings, reused.f1, reused.posting_date)


@register("postings_beyond_broadcast", O.with_ctes(
    f"select {', '.join(C.POSTINGS.fieldNames())} from postings"))
def q_postings_beyond_broadcast(spark, sf):
    """Postings under rules that count as too large to broadcast: every lookup is
    a salted shuffle join, with event names that hold a third of all rows."""
    lay = fixture_layers(spark, sf)
    rules = replace(lay.rules, _sizes=None, _widths=None, _names=None, _dups=None, max_broadcast_rows=0)
    return postings(lay.f1, rules.validate())


@register("event_postings", O.with_ctes(
    f"""select {', '.join(C.POSTINGS.fieldNames())} from postings
 where TR_ID_EVNEG in (select min(TR_ID_EVNEG) from postings)"""))
def q_event_postings(spark, sf):
    """All postings of one event, found by its id (the smallest one)."""
    lay = fixture_layers(spark, sf)
    first = lay.postings.agg(F.min("TR_ID_EVNEG")).first()[0]
    return by_event(lay.postings, first)


@register("layer_counts", O.with_ctes(
    "select 'RAW' as layer, count(*) as n from raw "
    "union all select 'F0', count(*) from f0 "
    "union all select 'F1', count(*) from f1 "
    "union all select 'F2_CONT', count(*) from postings "
    "union all select 'PS', count(*) from ps", {"ps": O.ledger_select()}))
def q_layer_counts(spark, sf):
    """Counts of the stored layers of one run; the receipts are counted while
    F0 is written, so nothing is computed twice."""
    lay = fixture_layers(spark, sf)
    seen = Observation()
    lay.raw = lay.raw.observe(seen, F.count(F.lit(1)).alias("n"))
    paths = publish_layers(lay, scratch_path(spark, "counted"))
    raw = spark.createDataFrame([("RAW", seen.get["n"])], "layer string, n long")
    return raw.unionByName(layer_counts({k: spark.read.parquet(p) for k, p in paths.items()}))


_LINES = NON_LIFE_LINES + LIFE_LINES
_IN_LINES = ", ".join(f"'{c}'" for c in _LINES)


@register("line_filter", O.with_ctes(
    "select COD_RECIBO, COD_RAMO, COD_EST_REC, COD_AGENCIA from f0 "
    f"where COD_RAMO in ({_IN_LINES})"))
def q_line_filter(spark, sf):
    f0 = fixture_layers(spark, sf).f0
    return line_filter(f0, _LINES).select("COD_RECIBO", "COD_RAMO", "COD_EST_REC",
                                          "COD_AGENCIA")


# The case grid (status x product-line group x mediator type)
# and rows kept per case.
CASE_STATUSES = ["DV", "PT", "CB", "NA"]
CASE_LINE_GROUPS = [list(NON_LIFE_LINES), list(LIFE_LINES)]
CASE_AGENCIES = ["C", "A", "S", "X", "E"]
ROWS_PER_CASE = 5


def case_dims():
    return [
        [F.col("COD_EST_REC") == s for s in CASE_STATUSES],
        [F.col("COD_RAMO").isin(*g) for g in CASE_LINE_GROUPS],
        [F.col("COD_AGENCIA") == a for a in CASE_AGENCIES],
    ]


def _case_sql() -> str:
    si = " ".join(f"when '{s}' then {i}" for i, s in enumerate(CASE_STATUSES))
    ri = " ".join("when COD_RAMO in (" + ", ".join(f"'{c}'" for c in g) + f") then {i}"
                  for i, g in enumerate(CASE_LINE_GROUPS))
    ai = " ".join(f"when '{a}' then {i}" for i, a in enumerate(CASE_AGENCIES))
    return O.with_ctes(f"""
select {O.F0_COLS}, {CASE_COLUMN} from (
 select *, row_number() over (partition by {CASE_COLUMN} order by COD_RECIBO) as rn from (
  select *, concat_ws('-', cast(si as varchar), cast(ri as varchar), cast(ai as varchar)) as {CASE_COLUMN}
  from (select *, case COD_EST_REC {si} end as si, case {ri} end as ri,
               case COD_AGENCIA {ai} end as ai
        from f0 where COD_RAMO in ({_IN_LINES}))
  where si is not null and ri is not null and ai is not null))
where rn <= {ROWS_PER_CASE}""")


@register("case_sample", _case_sql())
def q_case_sample(spark, sf):
    f0 = line_filter(fixture_layers(spark, sf).f0, _LINES)
    return case_sample(f0, case_dims(), ROWS_PER_CASE, ["COD_RECIBO"])


# Fixed value: month of the old snapshot; the new one is the whole extract.
OLD_CUT = "1996-06"


def _as_of_sql(cut: str) -> str:
    anu = f"""case when "F.LIQ.ANU." <= '{cut}' then "F.LIQ.ANU." else '0001-01' end"""
    cob = f"""case when "F.LIQ.COB." <= '{cut}' then "F.LIQ.COB." else '0001-01' end"""
    number = """case when "T.MEDIADOR" = 'U' then 'U' || "N.RECIBO" else "N.RECIBO" end"""
    return f"""select * replace ({anu} as "F.LIQ.ANU.", {cob} as "F.LIQ.COB.", {number} as "N.RECIBO")
from raw where "F.LIQ.CAR." <= '{cut}'"""


def _snapshot_ctes() -> dict[str, str]:
    return {"raw_old": _as_of_sql(OLD_CUT), "f0_old": O.f0_select("raw_old"),
            "f0_new": O.f0_select("raw")}


def _snapshots(spark, sf):
    raw = fixture_layers(spark, sf).raw
    return normalize_receipts(receipts_as_of(raw, OLD_CUT)), normalize_receipts(raw)


def _changes_sql() -> str:
    o_cols = ", ".join(f"o.{c}" for c in C.F0_NAMES)
    n_cols = ", ".join(f"n.{c}" for c in C.F0_NAMES)
    differs = " or ".join(f"o.{c} is distinct from n.{c}" for c in C.F0_NAMES)
    return O.with_ctes(f"""
select {o_cols}, 'delete' as _change_type from f0_old o
 where not exists (select 1 from f0_new n where n.COD_RECIBO = o.COD_RECIBO)
union all
select {n_cols}, 'insert' from f0_new n
 where not exists (select 1 from f0_old o where o.COD_RECIBO = n.COD_RECIBO)
union all
select {o_cols}, 'update_preimage' from f0_old o join f0_new n on o.COD_RECIBO = n.COD_RECIBO
 where {differs}
union all
select {n_cols}, 'update_postimage' from f0_old o join f0_new n on o.COD_RECIBO = n.COD_RECIBO
 where {differs}""", _snapshot_ctes())


@register("snapshot_changes", _changes_sql())
def q_snapshot_changes(spark, sf):
    old, new = _snapshots(spark, sf)
    return snapshot_changes(old, new, ["COD_RECIBO"])


@register("stored_snapshot_changes", _changes_sql())
def q_stored_snapshot_changes(spark, sf):
    """The same between two stored snapshots, by key and digest."""
    paths = [full_refresh(df, C.F0, scratch_path(spark, "snapshot")) for df in _snapshots(spark, sf)]
    old, new = (spark.read.schema(C.F0).parquet(p) for p in paths)
    return snapshot_changes(old, new, ["COD_RECIBO"], stored=True)


# Months of the snapshots between the first and the whole extract.
CUTS = (OLD_CUT, "1997-01", "1997-09", None)


def _receipt_versions(spark, sf):
    """The receipt table with one version per snapshot; receipts that a later
    snapshot no longer has (renumbered ones) are removed."""
    raw = fixture_layers(spark, sf).raw
    table = KeyedTable(spark, scratch_path(spark, "receipts"), C.F0, ["COD_RECIBO"], buckets=8)
    for cut in CUTS:
        now = normalize_receipts(raw if cut is None else receipts_as_of(raw, cut))
        gone = table.read().select("COD_RECIBO").join(now.select("COD_RECIBO"), "COD_RECIBO", "left_anti")
        table.upsert(now, removed=gone, unique=False)
    return table


def _version_ctes() -> dict[str, str]:
    out = {}
    for i, cut in enumerate(CUTS, 1):
        if cut is not None:
            out[f"raw_{i}"] = _as_of_sql(cut)
        out[f"f0_{i}"] = O.f0_select("raw" if cut is None else f"raw_{i}")
    return out


def _diff_sql(old: str, new: str, version: int | None = None) -> str:
    extra = "" if version is None else f", {version} as version"
    o_cols = ", ".join(f"o.{c}" for c in C.F0_NAMES)
    n_cols = ", ".join(f"n.{c}" for c in C.F0_NAMES)
    differs = " or ".join(f"o.{c} is distinct from n.{c}" for c in C.F0_NAMES)
    both = f"from {old} o join {new} n on o.COD_RECIBO = n.COD_RECIBO where {differs}"
    return f"""
select {o_cols}, 'delete' as _change_type{extra} from {old} o
 left join {new} n on n.COD_RECIBO = o.COD_RECIBO where n.COD_RECIBO is null
union all
select {n_cols}, 'insert'{extra} from {new} n
 left join {old} o on n.COD_RECIBO = o.COD_RECIBO where o.COD_RECIBO is null
union all select {o_cols}, 'update_preimage'{extra} {both}
union all select {n_cols}, 'update_postimage'{extra} {both}"""


@register("changes_between_versions", O.with_ctes(
    _diff_sql("f0_1", f"f0_{len(CUTS)}"), _version_ctes()))
def q_changes_between_versions(spark, sf):
    """Net changes from the first to the last of four stored versions, composed
    from the versions' change sets: the direct diff of the two."""
    return _receipt_versions(spark, sf).changes_between(1)


@register("changes_by_version", O.with_ctes(
    " union all ".join(_diff_sql(f"f0_{i}", f"f0_{i + 1}", i + 1) for i in range(1, len(CUTS))),
    _version_ctes()))
def q_changes_by_version(spark, sf):
    """The changes of every version after the first, step by step."""
    return _receipt_versions(spark, sf).steps(1)


def _upsert_sql() -> str:
    return O.with_ctes(f"""
select {O.F0_COLS} from f0_old o
 where not exists (select 1 from f0_new u where u.COD_RECIBO = o.COD_RECIBO)
union all
select {O.F0_COLS} from f0_new""", _snapshot_ctes())


@register("upsert_by_key", _upsert_sql())
def q_upsert_by_key(spark, sf):
    old, new = _snapshots(spark, sf)
    return upsert(old, new, ["COD_RECIBO"])


@register("stored_upsert", _upsert_sql())
def q_stored_upsert(spark, sf):
    """The old snapshot stored, then the new one merged into it by key: two
    stored upserts, read back from the last version."""
    old, new = _snapshots(spark, sf)
    table = KeyedTable(spark, scratch_path(spark, "receipts"), C.F0, ["COD_RECIBO"], buckets=8)
    table.upsert(old, unique=False)
    table.upsert(new, unique=False)
    return table.read()


@register("ledger_incremental", O.with_ctes(
    f"select {', '.join(C.LEDGER.fieldNames())} from ps", {"ps": O.ledger_select()}))
def q_ledger_incremental(spark, sf):
    """Ledger of the new snapshot computed incrementally: partial sums of the
    old snapshot plus signed corrections for the receipts that changed."""
    from ledgerly.operators.enrich import business_events
    from ledgerly.operators.ledger import (
        LEDGER_EVENT_COLUMNS,
        ledger_corrections,
        ledger_from_partials,
        signed_partials,
    )
    lay = fixture_layers(spark, sf)
    rules = lay.rules.validate()
    old, new = _snapshots(spark, sf)
    old_f1 = business_events(old, lay.product_dim, rules.max_broadcast_rows)
    base = signed_partials(postings(old_f1, rules, carry=LEDGER_EVENT_COLUMNS))
    changes = snapshot_changes(old, new, ["COD_RECIBO"], digest_first=True)
    changed_f1 = business_events(changes, lay.product_dim, rules.max_broadcast_rows,
                                 keep=["_change_type"])
    delta = ledger_corrections(changed_f1, rules)
    return ledger_from_partials(base.unionByName(delta), lay.posting_date)


@register("receipt_key_profile", O.with_ctes(
    "select (select count(*) from f0) as n_lines, "
    "(select count(*) from (select distinct * from f0)) as n_distinct_lines, "
    "(select count(distinct COD_RECIBO) from f0) as n_receipts"))
def q_receipt_key_profile(spark, sf):
    return receipt_key_profile(fixture_layers(spark, sf).f0)
