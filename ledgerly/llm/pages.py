"""HTML extraction by wrapper inference.

The pages of a host are described by one union-free wrapper (see ``wrappers``):
every task folds its pages into one partial wrapper per host, and the partial
wrappers of a host are aligned in rounds of at most ``FAN_IN`` tasks' worth, so
no task ever sees a host's pages, however many there are. Of the finished
wrapper, every text slot gets a level: slots under menus, headers, footers,
sidebars, notices, adverts, forms and comments get none; slots in an article
come first, then those in a main part, then those in parts named like one, then
all others. Among the others, slots whose text is the same on all pages of the
host and repeated parts that consist of links come last: they are the template.

A page is then read along its host's wrapper: of its slots with text, those of
the best level are the main text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.common import stored, without
from ledgerly.llm.wrappers import Reader, Shapes, Wrapper
from ledgerly.operators.skew import salted_join

#: Tasks whose partial wrappers one merge task takes at most.
FAN_IN = 64
#: Partial wrappers, and slots in them, that a task holds before it hands them on.
MOST_HOSTS, MOST_SLOTS = 2048, 1 << 17
#: Slot tables are broadcast up to this total size; beyond, pages are shuffled.
BROADCAST_BYTES = 32 << 20

# What is not main text, by element and by words in class, id or role.
CHROME_TAGS = frozenset(
    "head nav header footer aside form button select datalist dialog menu template svg object "
    "canvas audio video map applet fieldset".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo "
    "promos promotion banner banners nav navbar navigation menu menus menubar breadcrumb breadcrumbs "
    "masthead header footer sidebar sidebars aside complementary contentinfo widget widgets notice "
    "notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup "
    "login search form forms comment comments disqus respond reply replies share sharing social "
    "related recommended recommendations pagination pager toolbar alert dialog".split())
#: Words that make even an article or main part something else.
CHROME_PARTS = frozenset(
    "ad ads advert advertisement sponsored promo comment comments reply replies related teaser".split())
CONTENT_WORDS = frozenset("article content main post entry story articlebody".split())
_HEADERS = frozenset(("header", "masthead"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_NEGATIONS = frozenset(("has", "have", "with", "without", "no", "not", "is"))

ARTICLE, MAIN, NAMED, OTHER, TEMPLATE = range(1, 6)
_KEY = re.compile(r"([.#@*])([^.#@*]+)")


@lru_cache(maxsize=1 << 14)
def _traits(key: str) -> tuple[str, frozenset[str], bool, bool]:
    """Tag of an element key, its chrome words, and whether it is named as an
    article's body or as a content part."""
    tag = re.match(r"[^.#@*]+", key)
    tag = tag[0] if tag else ""
    words, parts, exact, body = set(), set(), set(), False
    for sign, name in _KEY.findall(key):
        pieces = [p for p in re.split(r"[^a-z]+", name) if p]
        if not pieces or pieces[0] in _NEGATIONS:
            continue
        exact.add(name)
        body = body or sign == "*" and name == "articlebody" or sign == "@" and name == "article"
        words |= CHROME_WORDS.intersection(pieces)
        parts |= CONTENT_WORDS.intersection(pieces)
        if sign == "@" and name == "main":
            tag = "main"
    if tag in ("html", "body"):
        words, parts, body = set(), set(), False
    elif tag in ("article", "main") or body:
        words = CHROME_PARTS & exact
    if tag in CHROME_TAGS:
        words.add("header" if tag == "header" else tag)
    return tag, frozenset(words), tag == "article" or body, bool(parts)


def slot_level(path: str) -> int | None:
    """Level of a text slot by the elements around it; None: no main text."""
    level, header = OTHER, False
    for key in path.split("/")[1:]:
        tag, chrome, article, named = _traits(key)
        if chrome:
            # the headings in an article's own header are its title
            if not (chrome <= _HEADERS and level <= MAIN):
                return None
            header = True
        if header and tag in _HEADINGS:
            header = False
        found = ARTICLE if article else MAIN if tag == "main" else NAMED if named else OTHER
        level = min(level, found)
    return None if header else level


def slot_levels(wrapper: Wrapper, shapes: Shapes) -> dict[str, int]:
    """Levels of a wrapper's text slots; slots that are no main text are left out."""
    levels = {}
    repeated = None
    for path, (pages, size, links, digest) in wrapper.slots.items():
        level = slot_level(path)
        if level == OTHER:
            if repeated is None:
                repeated = shapes.repeated_paths(wrapper.shape)
            if pages > 1 and digest >= 0 or 2 * links > size and path in repeated:
                level = TEMPLATE
        if level is not None:
            levels[path] = level
    return levels


def main_text(reader: Reader, levels: dict[str, int], html: str) -> str:
    """Text of the page's best slots. Character references are decoded, white
    space inside a block is one space, blocks are joined by one space."""
    texts, _ = reader.read(html)
    paths, level_of = reader.paths, {}
    best = None
    for item in texts:
        if item is not None:
            path = item[0]
            if path not in level_of:
                level_of[path] = levels.get(paths[path])
            level = level_of[path]
            if level is not None and (best is None or level < best) and _decoded(item[1]).strip():
                best = level
    if best is None:
        return ""
    out = [" " if item is None else _decoded(item[1]) for item in texts
           if item is None or level_of[item[0]] == best]
    return " ".join("".join(out).split())


def _decoded(text: str) -> str:
    return unescape(text) if "&" in text else text


def host_of(url: str = "url") -> Column:
    """Host of an address, lower case, without user and port; addresses without
    one (and nulls) share the empty host."""
    found = F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


_PARTIAL = "host string, n_pages long, wrapper string, part int"


def _partial_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    reader, found, part = Reader(), {}, TaskContext.get().partitionId()

    def handed_on() -> pd.DataFrame:
        rows = [(host, w.pages, w.dumps(reader.shapes), part) for host, w in found.items()]
        found.clear()
        reader.renew()
        return pd.DataFrame(rows, columns=["host", "n_pages", "wrapper", "part"])

    slots = 0
    for batch in batches:
        for host, html in zip(batch["host"], batch["html"], strict=True):
            w = found.get(host)
            if w is None:
                w = found[host] = Wrapper()
            slots -= len(w.slots)
            w.add_page(reader, html or "")
            slots += len(w.slots)
            if len(found) >= MOST_HOSTS or slots >= MOST_SLOTS or reader.shapes.full():
                yield handed_on()
                slots = 0
    yield handed_on()


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """Partial wrappers of one host, in a fixed order -> one."""
    shapes, total = Shapes(), Wrapper()
    for text in sorted(group["wrapper"]):
        total.add(Wrapper.loads(text, shapes), shapes)
    return pd.DataFrame([(group["host"].iloc[0], total.pages, total.dumps(shapes), group["part"].iloc[0])],
                        columns=["host", "n_pages", "wrapper", "part"])


def infer_wrappers(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``(host, n_pages, wrapper)``: one wrapper (JSON) per host, from all pages.

    Null pages count as empty ones. A host's partial wrappers are aligned in
    rounds; every round is a stored table."""
    rows = pages.select(host_of(url).alias("host"), F.col(f"`{html}`").alias("html"))
    partial = stored(rows.mapInPandas(_partial_wrappers, _PARTIAL), "page-wrappers")
    last = partial.agg(F.max("part")).first()[0] or 0
    while True:
        last //= FAN_IN
        dealt = partial.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        partial = stored(dealt.groupBy("host", "part").applyInPandas(_merged, _PARTIAL), "page-wrappers")
        if not last:
            return partial.drop("part")


def expressions(wrappers: DataFrame) -> DataFrame:
    """``wrappers`` plus ``expression``: the wrapper as a regular expression."""

    @pandas_udf("string")
    def shown(texts: pd.Series) -> pd.Series:
        shapes = Shapes()
        return texts.map(lambda t: shapes.expression(Wrapper.loads(t, shapes).shape))

    return wrappers.withColumn("expression", shown("wrapper"))


def _slot_tables(wrappers: DataFrame) -> DataFrame:
    @pandas_udf("string")
    def table(texts: pd.Series) -> pd.Series:
        shapes = Shapes()
        return texts.map(lambda t: json.dumps(slot_levels(Wrapper.loads(t, shapes), shapes)))

    return wrappers.select("host", table("wrapper").alias("__slots"))


@lru_cache(maxsize=512)
def _levels(text: str) -> dict[str, int]:
    return json.loads(text)


def read_along(pages: DataFrame, wrappers: DataFrame, html: str = "html", url: str = "url",
               out: str = "text", spread_by: list[str] | None = None,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` plus the main text of each, read along its host's wrapper.

    The hosts' slot tables are broadcast if their measured size allows; else
    pages meet them in a shuffle that deals the pages of hot hosts over many
    tasks (by ``spread_by``, the address if not given)."""
    @pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        reader = Reader()
        for texts, slots in batches:
            found = []
            for h, s in zip(texts, slots, strict=True):
                reader.renew()
                found.append(main_text(reader, _levels(s or "{}"), h) if h else "")
            yield pd.Series(found, dtype="object")

    tables = stored(_slot_tables(wrappers), "page-slots")
    size = tables.agg(F.sum(F.length("__slots") + F.length("host") + 16)).first()[0] or 0
    named = without(pages, *{out} - {html, url}).withColumn("__host", host_of(url))
    tables = tables.withColumnRenamed("host", "__host")
    if size <= broadcast_bytes:
        joined = named.join(F.broadcast(tables), "__host", "left")
    else:
        joined = salted_join(named, tables, ["__host"], spread_by or [url], "left")
    return joined.withColumn(out, extract(F.col(f"`{html}`"), "__slots")).drop("__host", "__slots")


def extract_main_text(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text",
                      spread_by: list[str] | None = None,
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` plus ``text``: the main text of the whole page.

    Null and empty pages, and pages without any main text, have the empty text;
    pages without a host are aligned with each other. Pages of a host with one
    page, and repeated pages, are read like all others. Extra columns pass
    through; a column named ``text`` is replaced; an empty table gives an empty
    result."""
    return read_along(pages, infer_wrappers(pages, html, url), html, url, out, spread_by, broadcast_bytes)
