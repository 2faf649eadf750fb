"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each oracle is written as plain SQL over the driver's tables. Rule tables are
inline ``VALUES`` rendered from the same fixture lists the Spark side reads.
The account-rule match is deliberately written in the *other* shape (rules
pivoted by attribute, one join per attribute, ``UNION ALL``), so the oracle
cross-checks the single-join plan used on the Spark side.
"""

from __future__ import annotations

from ledgerly import contracts as C
from ledgerly.sources import fixtures as FX

POSTING_DATE = "24062024"

RAW_SQL = """
select cast(o_orderkey as varchar) as "POLIZA",
 lpad(cast(l_linenumber as varchar),2,'0') as "RAMO",
 lpad(cast(l_suppkey % 5 as varchar),3,'0') as "MODALIDAD",
 concat('C',cast(l_linenumber as varchar)) as "RAMO_CONT.",
 concat('M',cast(l_suppkey % 5 as varchar)) as "MODALI.CONT.",
 concat_ws('-',cast(l_orderkey as varchar),cast(l_linenumber as varchar),cast(l_partkey as varchar),cast(l_suppkey as varchar),substr(cast(l_shipdate as varchar),1,10)) as "N.RECIBO",
 replace(cast(cast(l_extendedprice as decimal(13,2)) as varchar),'.',',') as "IMP.PRIMA",
 replace(cast(cast(l_discount as decimal(13,2)) as varchar),'.',',') as "IMP.BONIFIC.",
 replace(cast(cast(l_tax as decimal(13,2)) as varchar),'.',',') as "IMP.IPS",
 replace(cast(cast(l_quantity as decimal(13,2)) as varchar),'.',',') as "IMP.CONSORC.",
 case when l_partkey % 10 = 0 then '' else '1,25' end as "IMP.CLEA",
 case when l_partkey % 10 = 1 then '1.234,56' else '0,10' end as "IMP.ARB.",
 replace(cast(cast(l_quantity as decimal(13,2)) as varchar),'.',',') as "IMP.COMI.",
 replace(cast(cast(o_totalprice as decimal(13,2)) as varchar),'.',',') as "IMP.RECIBO",
 substr(cast(o_orderdate as varchar),1,10) as "F.EFECTO",
 substr(cast(o_orderdate + interval 1 year as varchar),1,10) as "F.VENCIM.",
 substr(cast(o_orderdate as varchar),1,7) as "F.LIQ.CAR.",
 case when l_returnflag='R' then substr(cast(l_shipdate as varchar),1,7) else '0001-01' end as "F.LIQ.ANU.",
 case when l_linestatus='F' then substr(cast(l_shipdate + interval 1 month as varchar),1,7) else '0001-01' end as "F.LIQ.COB.",
 cast(null as varchar) as "F.PAGO",
 case substr(o_orderpriority,1,1) when '1' then 'RPA' when '2' then 'RPA' when '3' then 'RSUP' else 'REXT' end as "TIPO_DOC.",
 cast(o_custkey % 50 as varchar) as "AGENCIA",
 substr('CEXLSUA',cast(l_suppkey % 7 as int)+1,1) as "T.MEDIADOR",
 cast(l_suppkey as varchar) as "MEDIADOR",
 substr(cast(l_shipdate as varchar),1,7) as "C.LIQUIDACION",
 'N' as "T.COMISION",
 '0,00' as "IMP.DTO.RECIBO"
from lineitem join orders on l_orderkey = o_orderkey
"""


def _m(field: str) -> str:
    return f"try_cast(replace(\"{field}\", ',', '.') as decimal(13,2))"


_STATUS = """case
  when "F.LIQ.CAR." <= "F.LIQ.COB." and "F.LIQ.ANU." <= "F.LIQ.COB." and "F.LIQ.COB." <> '0001-01' then 'CB'
  when "F.LIQ.CAR." <= "F.LIQ.ANU." and "F.LIQ.ANU." <> '0001-01' and "F.LIQ.COB." = '0001-01' then 'DV'
  when "F.LIQ.CAR." <> '0001-01' and "F.LIQ.ANU." = '0001-01' and "F.LIQ.COB." = '0001-01' then 'PT'
  else 'NA' end"""


def _f0_exprs() -> dict[str, str]:
    z = "cast(0 as decimal(13,2))"
    e = {
        "COD_SOCIEDAD": "'SSL1'", "COD_POLIZA": '"POLIZA"', "COD_RAMO": '"RAMO"',
        "COD_MODALIDAD": '"MODALIDAD"', "COD_GARANTIA": "''", "COD_CERTIFICADO": "''",
        "COD_RECIBO": '"N.RECIBO"', "MAR_NUEV_RECIBO": "'N'", "COD_DIVISA": "'EUR'",
        "IMP_PRIM_TARIFA": _m("IMP.PRIMA"), "IMP_PRIM_UNIC": _m("IMP.PRIMA"),
        "IMP_PRIM_PERIOD": z, "IMP_PRIM_EXTOR_EJER": z, "IMP_PRIM_EXTOR_EJER_ANT": z,
        "IMP_PRIM_ANUL_EJER_ANT": z, "BON_N_SINIESTRALIDAD": _m("IMP.BONIFIC."),
        "IPS": _m("IMP.IPS"), "TAS_CSS_REC_RIES_EXTR": _m("IMP.CONSORC."),
        "TAS_CSS_REC_FUN_LIQ": _m("IMP.CLEA"), "TAS_CSS_PRIM_PEND_COBR": z,
        "ARB_BOMBEROS": _m("IMP.ARB."), "IMP_COMISIONES": _m("IMP.COMI."),
        "IMP_RETEN_FISC": z, "IMP_TOT_RECIB": _m("IMP.RECIBO"),
        "CAR_RECIB": f"cast({_m('IMP.RECIBO')} as varchar)", "ID_MOV_ECON": "''",
        "FEC_MOV_ECON": '"F.EFECTO"', "FEC_EMI": '"F.LIQ.CAR."',
        "FEC_LIQ": f"""case ({_STATUS}) when 'CB' then "F.LIQ.COB." when 'DV' then "F.LIQ.ANU." when 'PT' then "F.LIQ.CAR." else '' end""",
        "COD_TIP_RECIB": '"TIPO_DOC."', "COD_EST_REC_ANT": "''", "COD_EST_REC": _STATUS,
        "REC_FRACCIONADO": "'N'", "MAR_RECIB_SIMUL": "'N'", "COMP": "'N'",
        "MAR_REINV": "'N'", "ENT_COLABORADORA": "''", "COD_TIP_SIN": "''",
        "COD_AGENCIA": '"T.MEDIADOR"', "COD_MEDIADOR": '"MEDIADOR"',
        "COD_TIP_GESTION": """case when "T.MEDIADOR" in ('C','E','X') then 'D' else 'C' end""",
        "CON_LIQUIDACION": '"C.LIQUIDACION"', "IMP_DESCUENTO": _m("IMP.DTO.RECIBO"),
        "IMP_PRIM_REAL": _m("IMP.RECIBO"), "IMP_COA": z, "PRE_RECOBRADAS": z,
        "NOM_DESTINATARIO": "'Nombre Tomador 1'", "NOM_POBL": "'Comunidad de Madrid'",
        "NIF": "'11223344A'", "CTA_BANC": "'01112222330011223344'",
        "ENT_BANCARIA": "'Banco A'", "TR_COD_RAMO_CONT": '"RAMO_CONT."',
        "TR_COD_MOD_CONT": '"MODALI.CONT."',
    }
    assert list(e) == C.F0_NAMES
    return e


def f0_select(source: str = "raw", extra: str = "") -> str:
    cols = ",\n ".join(f"{v} as {k}" for k, v in _f0_exprs().items())
    return f"select {cols}{extra} from {source}"


F0_COLS = ", ".join(C.F0_NAMES)


def _key(*cols: str) -> str:
    parts = [f"coalesce(cast(length(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), '-')"
             for c in cols]
    return "sha256(concat_ws(',', " + ", ".join(parts) + "))"


def f1_select(source: str = "f0") -> str:
    key = _key("s.COD_SOCIEDAD", "s.COD_RECIBO", "s.COD_DIVISA", "s.CON_LIQUIDACION",
               "s.COD_MEDIADOR", "s.COD_AGENCIA", "d.RAMO_POL", "d.MODALIDAD_POL",
               "d.Negocio", "d.Tipo_de_negocio")
    return f"""select {key} as TR_ID_EVNEG,
 {', '.join('s.' + c for c in C.F0_NAMES)},
 case when s.COD_TIP_RECIB = 'RPA' then 'RPRI' else s.COD_TIP_RECIB end as TR_COD_TIP_RECIB,
 case s.COD_EST_REC when 'CB' then 'COB' when 'DV' then 'DEV' when 'PT' then 'PTE' else s.COD_EST_REC end as TR_COD_EST_RECIB,
 case s.COD_AGENCIA when 'C' then 'CORR' when 'E' then 'ECOL' when 'X' then 'AGEX'
   when 'L' then 'SLU' when 'S' then 'SLU' when 'U' then 'SLU' else s.COD_AGENCIA end as TR_COD_AGENCIA,
 d.Negocio as TR_NEGOCIO, d.Tipo_de_negocio as TR_COD_TIP_NEGOCIO
from {source} s left join product_dim d
  on try_cast(s.COD_RAMO as integer) = try_cast(d.RAMO_POL as integer)
 and try_cast(s.COD_MODALIDAD as integer) = try_cast(d.MODALIDAD_POL as integer)"""


def _rule_ctes() -> dict[str, str]:
    rows = FX.fixture_rows()
    out = {k: FX.values_sql(rows[k], FX.FIXTURE_SCHEMAS[k], quote='"')
           for k in FX.FIXTURE_SCHEMAS if k != "product_dim"}
    out["product_dim_raw"] = FX.values_sql(rows["product_dim"], C.PRODUCT_DIM_RAW, quote='"')
    out["product_dim"] = """select coalesce(RAMO_POL, '') as RAMO_POL,
 coalesce(MODALIDAD_POL, '') as MODALIDAD_POL, coalesce(Negocio, '') as Negocio,
 coalesce("Tipo de Negocio", '') as Tipo_de_negocio
from (select distinct RAMO_POL, MODALIDAD_POL, Negocio, "Tipo de Negocio" from product_dim_raw)"""
    return out


def attribute_names() -> list[str]:
    return sorted({name for name, _, _ in FX.ACCOUNT_RULE_CELLS})


def amount_names() -> list[str]:
    return sorted({f for _, f in FX.AMOUNT_FIELDS})


def aux_names() -> list[str]:
    return sorted({a for *_, a in FX.CHART_ROWS if a is not None})


def _matched_union(lines: str = "lines") -> str:
    branches = []
    for a in attribute_names():
        branches.append(f"""select l.*, cc.COD_CUENTA, cc.DESC_CUENTA, cc.IND_TIPO, cc.CAMPO_AUX
from {lines} l join cc on l.COD_SOCIEDAD = cc.COD_SOCIEDAD and l.ID_ESTRUCTURA = cc.ID_ESTRUCTURA
 and l.COD_ASIENTO = cc.COD_ASIENTO and try_cast(l.NATURALEZA as integer) = cc.NATURALEZA
 and l.{a} = cc."{a}"
where cc."{a}" is not null""")
    return "\nunion all\n".join(branches)


def _wide() -> str:
    cells = ",\n ".join(f"""min(case when NOM_CAMPO = '{a}' then VALOR end) as "{a}\""""
                        for a in attribute_names())
    return f"""select COD_SOCIEDAD, ID_CUEN_ASIEN, ID_ESTRUCTURA, COD_ASIENTO, NATURALEZA, COD_CUENTA,
 {cells}
from account_rules where COD_CUENTA is not null
group by COD_SOCIEDAD, ID_CUEN_ASIEN, ID_ESTRUCTURA, COD_ASIENTO, NATURALEZA, COD_CUENTA"""


def _amount_pick() -> str:
    whens = " ".join(f"when '{a}' then {a}" for a in amount_names())
    return f"cast(case NOM_CAMPO {whens} end as decimal(13,2))"


def _aux_pick() -> str:
    whens = " ".join(f"when '{a}' then cast({a} as varchar)" for a in aux_names())
    return f"case CAMPO_AUX {whens} end" if whens else "cast(null as varchar)"


DESCRIBABLE = ("try_cast(IND_TIPO as integer) is not null and "
               "(try_cast(IND_TIPO as integer) <> 1 or CAMPO_AUX is not null) "
               "and NOM_CAMPO is not null")


def _posting_cols() -> str:
    return f"""TR_ID_EVNEG, TR_COD_RAMO_CONT, TR_COD_MOD_CONT, COD_CUENTA as TR_CUENTA_CONT,
 substring(COD_ASIENTO, 1, 2) as TR_COD_TIP_EVCON, COD_ASIENTO as TR_ID_EVCON,
 NATURALEZA as TR_NAT_EVCON,
 case when try_cast(IND_TIPO as integer) = 1
      then coalesce(DESC_CUENTA, 'null') || ' - ' || coalesce({_aux_pick()}, 'null')
      else DESC_CUENTA end as TR_CC_DES,
 {_amount_pick()} as TR_CC_IMP"""


LEDGER_KEYS = ["COD_SOCIEDAD", "TR_COD_TIP_EVCON", "TR_ID_EVCON", "COD_DIVISA",
               "CON_LIQUIDACION", "TR_NAT_EVCON", "COD_MEDIADOR", "TR_CUENTA_CONT",
               "TR_COD_AGENCIA", "TR_COD_RAMO_CONT", "TR_COD_MOD_CONT"]


def ledger_select(postings: str = "postings", events: str = "f1",
                  date_text: str = POSTING_DATE) -> str:
    keys = ", ".join(LEDGER_KEYS)
    return f"""select COD_SOCIEDAD, TR_COD_TIP_EVCON as CLASE_DOC, TR_ID_EVCON as REFER,
 COD_DIVISA as DIV, CON_LIQUIDACION as TEX_CABECERA, '{date_text}' as FECHA_CONTAB,
 TR_NAT_EVCON as CLAVE_CONTAB, COD_MEDIADOR as TERC, '' as NOM_1, '' as NOM_2,
 '' as POBL, '' as NIF, TR_CUENTA_CONT as NUM_CUENTA, IMP, TR_COD_AGENCIA as DIVIS,
 '' as C_COSTE, '' as ASIG, '' as TEXT, TR_COD_RAMO_CONT as RAMO_CON, '' as CANL,
 '' as INDICADOR_CME, TR_COD_MOD_CONT as MODALIDAD_CON
from (
 select {keys}, try_cast(sum(TR_CC_IMP) as decimal(13,2)) as IMP
 from (select p.*, e.COD_SOCIEDAD, e.COD_DIVISA, e.CON_LIQUIDACION, e.COD_MEDIADOR, e.TR_COD_AGENCIA
       from {postings} p join {events} e using (TR_ID_EVNEG))
 group by {keys})"""


def base_ctes(raw: str | None = None) -> dict[str, str]:
    """Every building block, in dependency order. ``raw`` replaces the receipt
    extract with SQL over ``raw_all`` (the full extract)."""
    ctes = {"raw": RAW_SQL} if raw is None else {"raw_all": RAW_SQL, "raw": raw}
    ctes.update(_rule_ctes())
    ctes["f0"] = f0_select()
    ctes["f1"] = f1_select()
    ctes["ev"] = "select *, concat_ws('_', TR_COD_TIP_RECIB, TR_COD_EST_RECIB) as EVENT_NEG from f1"
    ctes["valid"] = "select * from ev where EVENT_NEG in (select EVENT_NEG from event_master)"
    ctes["entries"] = """select v.*, r.COD_ASIENTO from valid v join event_relation r on v.EVENT_NEG = r.EVENT_NEG"""
    ctes["amount_structure"] = """select b.COD_SOCIEDAD, b.ID_ESTRUCTURA, b.COD_ASIENTO, b.NOM_IMPORTE, b.NATURALEZA, a.NOM_CAMPO
from entry_structure b join entry_amounts a
  on b.COD_SOCIEDAD = a.COD_SOCIEDAD and b.ID_ESTRUCTURA = a.ID_ESTRUCTURA
 and b.COD_ASIENTO = a.COD_ASIENTO and b.NOM_IMPORTE = a.NOM_IMPORTE"""
    ctes["lines"] = """select e.*, s.ID_ESTRUCTURA, s.NOM_IMPORTE, s.NATURALEZA, s.NOM_CAMPO
from entries e join amount_structure s on e.COD_ASIENTO = s.COD_ASIENTO and e.COD_SOCIEDAD = s.COD_SOCIEDAD"""
    ctes["wide"] = _wide()
    ctes["cc"] = """select w.*, c.DESC_CUENTA, c.IND_TIPO, c.CAMPO_AUX
from wide w join chart_of_accounts c on w.COD_CUENTA = c.NUM_CUENTA"""
    ctes["matched"] = _matched_union()
    ctes["postings"] = f"select {_posting_cols()} from matched where {DESCRIBABLE}"
    return ctes


def with_ctes(final: str, extra: dict[str, str] | None = None,
              raw: str | None = None) -> str:
    ctes = base_ctes(raw)
    ctes.update(extra or {})
    body = ",\n".join(f"{k} as (\n{v}\n)" for k, v in ctes.items())
    return f"with {body}\n{final}"
