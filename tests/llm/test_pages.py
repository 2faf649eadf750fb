import random
import re
from html import unescape
from html.parser import HTMLParser

import duckdb
from pyspark.sql import functions as F

from ledgerly.llm import pages as P
from ledgerly.llm.queries import op12_page_wrappers
from ledgerly.llm.wrappers import Reader, Shapes, Wrapper, _common
from tests.llm.conftest import SF

SCHEMA = "page_id long, url string, html string"


class ByTags(HTMLParser):
    """Plain reading of pages whose main text is what their article holds."""

    BLOCKS = {"p", "div", "h1", "h2", "h3", "ul", "ol", "li", "br", "article", "section", "table", "tr", "td"}
    CHROME = {"nav", "header", "footer", "aside", "form", "script", "style", "title"}

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.article, self.chrome, self.out = 0, [], []

    def handle_starttag(self, tag, attrs):
        mark = (dict(attrs).get("class") or "").split()
        if tag in self.CHROME or {"ad", "comments", "notice"} & set(mark):
            self.chrome.append(tag)
        elif self.chrome and tag == self.chrome[-1]:
            self.chrome.append(tag)
        self.article += tag == "article"
        if tag in self.BLOCKS:
            self.out.append(" ")

    def handle_endtag(self, tag):
        if self.chrome and tag == self.chrome[-1]:
            self.chrome.pop()
        self.article -= tag == "article"
        if tag in self.BLOCKS:
            self.out.append(" ")

    def put(self, text):
        if self.article and not self.chrome:
            self.out.append(text)

    def handle_data(self, data):
        self.put(data)

    def handle_entityref(self, name):
        self.put(f"&{name};")

    def handle_charref(self, name):
        self.put(f"&#{name};")


def by_tags(html):
    p = ByTags()
    p.feed(html or "")
    p.close()
    return " ".join(unescape("".join(p.out)).split())


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def extract(spark, pages, **kw):
    return texts(P.extract_main_text(spark.createDataFrame(pages, SCHEMA), **kw))


def wrapper_of(pages):
    reader, w = Reader(), Wrapper()
    for html in pages:
        w.add_page(reader, html)
    return reader.shapes.expression(w.shape), P.slot_levels(w, reader.shapes)


def words(rnd, n):
    return " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(n))


def test_query(spark):
    rows = duckdb.sql(f"select page_id, url, html from '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in op12_page_wrappers(spark, SF).collect()}
    assert len(got) == len(rows)
    for page, url, html in rows:
        article = html.split("<article>", 1)[1].rsplit("</article>", 1)[0]
        want = " ".join(unescape(re.sub(r"</?(p|h1|br)>", " ", article).replace("<b>", "")).split())
        assert got[page]["text"] == want and got[page]["url"] == url and got[page]["n_chars"] == len(want)


def test_alignment_finds_optional_and_repeated_parts():
    assert wrapper_of(["<ul><li>a</li></ul>", "<ul><li>b</li><li>c</li></ul>"])[0] == "<ul>(<li>TEXT</li>)+</ul>"
    assert wrapper_of(["<div><h2>a</h2><p>b</p></div>", "<div><p>c</p></div>"])[0] == (
        "<div>(<h2>TEXT</h2>)?<p>TEXT</p></div>")
    assert wrapper_of(["<dl>" + "<dt>a</dt><dd>b</dd>" * 3 + "</dl>"])[0] == (
        "<dl>(<dt>TEXT</dt><dd>TEXT</dd>)+</dl>")
    two = wrapper_of(["<div>" + "<h2>a</h2><p>b</p><p>c</p>" * 2 + "</div>", "<div><h2>a</h2><p>b</p></div>"])[0]
    assert two == "<div>(<h2>TEXT</h2>(<p>TEXT</p>)+)+</div>" or two.startswith("<div>(")


def test_long_streams_become_runs():
    rnd = random.Random(2)
    tags = ["p", "h2", "h3", "pre", "blockquote", "figure", "table"]
    pages = ["<div>" + "".join(f"<{t}>x</{t}>" for t in rnd.choices(tags, k=400)) + "</div>" for _ in range(20)]
    shown, levels = wrapper_of(pages)
    assert shown.startswith("<div>((<blockquote>") and shown.endswith(")*</div>") and len(levels) == len(tags)


def test_common_subsequences():
    for seed in range(60):
        rnd = random.Random(seed)
        a, b = (rnd.choices("abcd", k=rnd.randint(0, 12)) for _ in range(2))
        pairs = _common(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))
    many = _common([str(i) for i in range(400)], ["x"] + [str(i) for i in range(0, 800, 2)] + ["y"])
    assert len(many) == 200


def test_merge_describes_both_in_any_order():
    rnd = random.Random(4)
    pages = [f"<html><body>{'<div class=promo>x</div>' * (i % 2)}<article><h1>{i}</h1>"
             + "".join(rnd.choice(["<p>a</p>", "<ul><li>b</li></ul>", "<h2>c</h2><p>d</p>"])
                       for _ in range(rnd.randint(1, 6))) + "</article></body></html>" for i in range(30)]
    shapes, halves = Shapes(), []
    for part in (pages[::2], pages[1::2]):
        reader, w = Reader(), Wrapper()
        for html in part:
            w.add_page(reader, html)
        halves.append(w.dumps(reader.shapes))
    a, b = Wrapper(), Wrapper()
    for text in halves:
        a.add(Wrapper.loads(text, shapes), shapes)
    for text in reversed(halves):
        b.add(Wrapper.loads(text, shapes), shapes)
    assert a.pages == b.pages == 30 and a.slots == b.slots
    assert set(P.slot_levels(a, shapes)) == set(P.slot_levels(b, shapes)) == {
        "/html/body/article/h1", "/html/body/article/p", "/html/body/article/ul/li", "/html/body/article/h2"}


def marked_pages():
    rnd = random.Random(8)
    pages = []
    for i in range(24):
        body = "".join(f"<p>{words(rnd, 8)} <b>{i}</b>&amp;<a href='#'>link</a></p>"
                       + ("<div class='ad'>buy <p>now</p></div>" if j == 1 else "") for j in range(1 + i % 4))
        pages.append((i, f"https://one.example.com/{i}",
                      f"<!doctype html><html><head><title>T{i}</title><script>if (a<b) x='</p>'</script></head><body>"
                      f"<header>Site</header><nav><ul><li><a>{words(rnd, 1)}</a></li></ul></nav>"
                      f"<div class='notice'>We use cookies</div><article><h1>Title {i}</h1>{body}</article>"
                      f"<aside>side {i}</aside><form><p>mail</p></form><div class='comments'><article>nice!</article>"
                      f"</div><footer>&copy; {i}</footer></body></html>"))
    return pages


def test_marked_articles(spark):
    pages = marked_pages()
    got = extract(spark, pages)
    assert got == {i: by_tags(h) if "comments" not in h else by_tags(h.split("<aside>")[0]) for i, _, h in pages}
    assert got[0].startswith("Title 0 ") and "&link" in got[0] and "buy" not in got[1]


def test_template_is_found_without_marks(spark):
    rnd = random.Random(9)
    pages, want = [], {}
    for i in range(12):
        paragraphs = [words(rnd, 12) for _ in range(1 + i % 3)]
        links = "".join(f"<div><a href='/x'>{words(rnd, 1)}</a></div>" for _ in range(3))
        pages.append((i, "http://plain.example.org/a", f"<body><div>The daily page<table><tr><td>{links}</table>"
                      f"</div><div><h1>About {i}</h1>{''.join(f'<p>{p}' for p in paragraphs)}</div>"
                      "<center>Made with love</center></body>"))
        want[i] = " ".join([f"About {i}", *paragraphs])
    assert extract(spark, pages) == want


def test_edge_cases(spark):
    a = "<article><p>x  y\n z&nbsp;&lt;b&gt; &#65;&amp &copy</p>tail</article>"
    pages = [
        (1, "http://h.example.com", None), (2, "http://h.example.com", ""), (3, None, a), (4, "", a),
        (5, "no address", a), (6, "HTTP://U:P@H.example.com:8080/q?a", a), (None, "http://h.example.com", a),
        (8, "http://h.example.com", "<nav>only a menu</nav>"), (9, "http://h.example.com", "plain text, no tags"),
        (10, "http://h.example.com", "<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + " end</article>"),
        (11, "http://h.example.com", "<article>" + "<p>word " * 60000 + "</article>"),
        (12, "http://h.example.com", "<article><p>a < b <c <!-- x --> d</p><!-- open"),
        (13, "http://h.example.com", "<article>one<p>two<script>three"),
        (14, "http://h.example.com", "<article>in<b>li<i>ne</b></i>d</article><p>after"),
        (15, "http://h.example.com", "<p>" + "<b>" * 3000 + "bold" + "<article>x</p></article>"),
        (16, "http://h.example.com", '<article title="a>b" class=x>attr<br/>ibute</article>'),
        (17, "http://h.example.com", "</div></article></b>stray"),
        (18, "http://h.example.com", "<main><header><h1>Head</h1>by me</header><p>Body</p><nav>n</nav></main>"),
        (19, "http://h.example.com", '<article class="post comments-open"><p>kept</p><section id="comments">gone</section>'),
    ]
    got = extract(spark, pages + [pages[2]])
    plain = "x y z <b> A& © tail"
    assert got == {
        1: "", 2: "", 3: plain, 4: plain, 5: plain, 6: plain, None: plain, 8: "", 9: "plain text, no tags",
        10: "deep end", 11: " ".join(["word"] * 60000), 12: "a < b d", 13: "one two", 14: "inlined",
        15: "x", 16: "attr ibute", 17: "stray", 18: "Head Body", 19: "kept"}


def test_partitions_and_join_forms_agree(spark):
    rnd = random.Random(3)
    pages = marked_pages() + [
        (100 + i, f"https://{'hot' if i % 3 == 0 else f'h{i % 40}'}.example.net/{i}",
         f"<body><div class='top'>menu</div><div id='content'><p>{words(rnd, 5)}</p>"
         f"{'<h2>x</h2>' * (i % 2)}</div></body>") for i in range(600)]
    df = spark.createDataFrame(pages, SCHEMA)
    one = texts(P.extract_main_text(df.coalesce(1)))
    assert len(one) == len(pages) and all(one.values())
    assert texts(P.extract_main_text(df.repartition(9))) == one
    assert texts(P.extract_main_text(df.repartition(5), broadcast_bytes=0, spread_by=["page_id"])) == one
    wrappers = P.expressions(P.infer_wrappers(df.repartition(70, "page_id"))).collect()
    assert len(wrappers) == len({r["host"] for r in wrappers}) == 42
    assert sum(r["n_pages"] for r in wrappers) == len(pages)
    assert next(r for r in wrappers if r["host"] == "hot.example.net")["expression"] == (
        "<body><div.top>TEXT</div.top><div#content><p>TEXT</p>(<h2>TEXT</h2>)?</div#content></body>")


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame(marked_pages(), SCHEMA)
    crowded = df.select("*", *[F.lit("mine").alias(c) for c in ("text", "host", "wrapper", "part", "n_pages")])
    got = P.extract_main_text(crowded)
    assert texts(got) == texts(P.extract_main_text(df))
    assert got.first()["host"] == "mine" and got.first()["wrapper"] == "mine"
    empty = P.extract_main_text(df.limit(0))
    assert empty.count() == 0 and "text" in empty.columns
