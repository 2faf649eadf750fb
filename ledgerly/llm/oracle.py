"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

from ledgerly.llm import licenses as L
from ledgerly.llm import secret_scan as S


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The base secret rules, letters in either case spelt out so that
# no case folding beyond ASCII takes part.
_ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
           "[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?"
           "([A-Za-z0-9+/_.=-]+)")


def _kind(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    p = _text(pattern)
    return f"""select doc_id, '{kind}' as kind, {rank} as rank,
  unnest(list_transform(range(1, len(w) + 1), lambda i: {{'s': list_sum(g[1:i]) + coalesce(list_sum(w[1:i-1]), 0),
    'n': w[i], 'k': k[i]}})) as x, {least} as least
 from (select doc_id, list_transform(string_split_regex(text, {p}), lambda y: length(y)) as g,
    list_transform(regexp_extract_all(text, {p}, 0), lambda y: length(y)) as w,
    list_transform(regexp_extract_all(text, {p}, {group}), lambda y: length(y)) as k
   from documents where regexp_matches(text, {p}))"""


def _op4() -> str:
    kinds = [_kind("assign", 0, _ASSIGN, 2, 8), _kind("access", 1, "(AKIA[A-Z0-9]+)", 1, 16),
             _kind("hex", 2, "([0-9a-f]+)", 1, 32)]
    kinds += [_kind(r.kind, 3 + i, r.pattern, r.group, r.least) for i, r in enumerate(S.ADDED_RULES)]
    return f"""with found as (
 select doc_id, kind, rank, cast(x.s as bigint) as s, cast(x.s + x.n as bigint) as e
 from ({' union all '.join(kinds)}) where x.k >= least),
lines as (select doc_id, count(*) filter (kind = 'assign') as n_assign,
  count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 3) as base,
  string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans from found group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
 coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
 coalesce(spans, '') as spans
from documents d left join lines l using (doc_id)"""


_FOLD = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({t}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _op5() -> str:
    words = _WORDS.format(t=_FOLD.format(t="coalesce(text, '')"))
    return f"""with d as (select doc_id, {words} as w from documents),
b as (select cast(item_id as varchar) as item_id, {words} as w from benchmark),
win as (select distinct item_id, least(10, len(w)) as n, unnest(list_transform(
   range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i+9], ' '))) as win
  from b where len(w) > 0),
sizes as (select distinct n from win),
places as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from d, sizes where len(w) >= n),
hit as (select o.doc_id, o.i, o.n, win.item_id from (select doc_id, n, i,
   array_to_string(w[i:i+n-1], ' ') as win from places) o join win on win.win = o.win and win.n = o.n),
covered as (select doc_id, count(distinct p) as n_hit from (
   select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from hit where item_id is not null) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
 coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
 coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join items using (doc_id)"""


_OP7 = r"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
win as (select doc_id, i, sha256(array_to_string(w[i:i+34], ' ')) as h from (
  select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
twice as (select h from win group by h having count(*) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) as p from win join twice using (h)),
kept as (select doc_id, string_agg(x, ' ' order by p) as t, count(*) as n from (
  select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from d)
  anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
 sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)"""


# What the cuts of op 9 do to a lower-case text, as patterns without lookaround.
_OP9_CUTS = [
    (r"\r\n?", "\n"),
    (r"([0-9])\+", r"\1 or later"),
    (r"(?m)^[^a-z0-9\n]*(?:https?|ftp)://[^ \t\n\v\f\r]+[^a-z0-9\n]*$", ""),
    (r"(\A|\n)[^a-z0-9\n]*(?:(?:dnl|rem)[ \t]+)?", r"\1"),
    (r"[.;!?]([ \t\n])", r"P\1"),
    (r":[ \t]+([^ \t\n])", "\n\\1"),
    (r":[ \t]+([^ \t\n])", "\n\\1"),  # neighbours share a character
    (r"[^a-z0-9\nP]+", " "),
    (r" ?\n ?", "\n"),
    (r"\n{2,}", "P"),
    (r"[\n ]?P[\nP ]*", "P"),
    (r"\A | \z", ""),
]


def _op9() -> str:
    known = {L.normalise(s): i for i, group in L.SENTENCES.items() for s in group}
    table = ", ".join(f"({_text(s)}, {_text(i)})" for s, i in sorted(known.items()))
    first: dict[str, L.LicenseRule] = {}
    for r in L.RULES:
        first.setdefault("".join(f"<{i}>" for i in r.sentences), r)
    rules = ", ".join(f"({_text(k)}, {_text(r.license)}, {_text(r.category)})"
                      for k, r in first.items())
    cut = _FOLD.format(t="coalesce(text, '')")
    for pattern, to in _OP9_CUTS:
        cut = f"regexp_replace({cut}, {_text(pattern)}, {_text(to)}, 'g')"
    # Every cut is doubled, so that the sentences on both sides have one each.
    longest = sorted([*known], key=lambda s: (-len(s), s))
    gap = r"(?: |\n\n)"
    spdx = gap.join(["spdx", "license", "identifier"]) + gap + r"[^\nP]+"
    piece = rf"[\nP]({'|'.join(s.replace(' ', gap) for s in longest)}|{spdx}|[^\nP]+)[\nP]"
    n = len(L.SPDX)
    return f"""with sentence(norm, id) as (values {table}), rule(line, license, category) as (values {rules}),
cuts as (select doc_id, {cut} as t from documents),
likely as (select doc_id, chr(10) || regexp_replace(t, '([\\nP])', '\\1\\1', 'g') || chr(10) as t from cuts
  where regexp_matches(translate(t, chr(10) || 'P', '  '), {_text('|'.join([*longest, L.SPDX]))})),
parts as (select doc_id, unnest(m) as s, unnest(range(1, len(m) + 1)) as p from (
  select doc_id, regexp_extract_all(t, {_text(piece)}, 1) as m from likely)),
plain as (select doc_id, p, trim(regexp_replace(s, '\\n\\n', ' ', 'g')) as s from parts),
named as (select doc_id, p, case when starts_with(s, '{L.SPDX}') and s not in (select norm from sentence)
  then list_transform(string_split_regex(replace(substr(s, {n + 1}), ' or later', ' orlater'), ' (?:or|and) '),
    lambda x: '{L.SPDX}' || replace(regexp_replace(x, ' with .*', ''), ' orlater', ' or later'))
  else [s] end as terms from plain where s <> '' and not regexp_matches(s, {_text(L.NEUTRAL)})),
normal as (select doc_id, p, unnest(terms) as norm, unnest(range(len(terms))) as q from named),
ids as (select doc_id, p, q, coalesce(id, '') as id from normal left join sentence using (norm)),
lines as (select doc_id, string_agg('<' || id || '>', '' order by p, q) as line,
  string_agg(id, ',' order by p, q) filter (id <> '') as sentence_ids from ids group by doc_id
  having count(*) filter (id <> '') > 0),
found as (select doc_id, unnest(m) as line, unnest(range(1, len(m) + 1)) as p from (
  select doc_id, regexp_extract_all(line, {_text('(' + '|'.join(first) + ')')}) as m from lines)),
licensed as (select doc_id, count(*) as n, string_agg(license, ',' order by p) as licenses,
  array_to_string(list_sort(list(distinct category)), ',') as categories
  from found join rule using (line) group by doc_id)
select d.doc_id, coalesce(n, 0) as n_licenses, coalesce(l.sentence_ids, '') as sentence_ids,
 coalesce(licenses, '') as licenses, coalesce(categories, '') as categories
from documents d left join lines l using (doc_id) left join licensed using (doc_id)"""


def _nearest(book: str) -> str:
    """Nearest entry of every part; ties go to the lower index."""
    return f"""select vec_id, label, part, x, min(struct_pack(d := d, e := entry)) as near from (
  select p.*, b.entry, cast(list_sum(list_transform(list_zip(p.x, b.x),
    lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d
  from parts p join {book} b using (part)) group by all"""


def _op13(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    steps = [f"""kept as materialized (select vec_id, label, list_transform(embedding,
   lambda v: cast(floor(1024 * cast(v as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
parts as materialized (select vec_id, label, part, v[part * w + 1:(part + 1) * w] as x from (
  select *, len(v) // {parts} as w from kept), range({parts}) t(part)),
book0 as materialized (select part, entry, x from (select part, x,
  row_number() over (partition by part order by vec_id) - 1 as entry from parts) where entry < {entries})"""]
    for r in range(rounds):
        steps.append(f"""near{r} as materialized ({_nearest(f'book{r}')}),
sums{r} as (select part, entry, i, sum(c) as s, count(*) as n from (select part, near.e as entry,
  unnest(x) as c, unnest(range(len(x))) as i from near{r}) group by all),
moved{r} as (select part, entry, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as x
  from sums{r} group by all),
book{r + 1} as materialized (select part, entry, coalesce(m.x, b.x) as x
  from book{r} b left join moved{r} m using (part, entry))""")
    return "with " + ",\n".join(steps) + f""",
final as materialized ({_nearest(f'book{rounds}')}),
coded as (select vec_id, label, string_agg(printf('%02x', near.e), '' order by part) as code,
  cast(sum(near.d) as bigint) as error from final group by all),
digest as (select sha256(string_agg(cast(c as varchar), ',' order by part, entry, i)) as h from (
  select part, entry, unnest(x) as c, unnest(range(len(x))) as i from book{rounds}))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
 h as codebooks_sha256 from coded, digest"""


def oracles() -> dict[str, str]:
    return {"op4_blob_ledger": _op4(), "op5_ngram_decontamination": _op5(),
            "op7_count_min_substrings": _OP7, "op9_license_scan": _op9(),
            "op13_equal_average_codes": _op13()}
