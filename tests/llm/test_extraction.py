"""HTML extraction: the given pages against a plain reading of their article, made hosts, and odd pages."""

from __future__ import annotations

import html
import re

import duckdb
import pytest

from tablelift.llm import html_pages, queries, templates

SF = "/root/testdata/sf0.001"


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page or "", re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", inside[1]) if inside else []
    plain = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts]
    return "\n\n".join(x for x in plain if x)


def test_given_pages(spark):
    rows = duckdb.sql(f"select page_id, url, html from '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in queries.QUERIES["op13_html_extraction"](spark, SF).collect()}
    assert len(got) == len(rows)
    for page, url, text in rows:
        wanted = article(text)
        assert (got[page]["url"], got[page]["text"], got[page]["n_chars"]) == (url, wanted, len(wanted))
    assert max(r["n_template"] for r in got.values()) > 10


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def site(i, notice="All rights of this notice are kept."):
    body = "".join(f"<p>Paragraph {i * 7 + k} about subject{i}x{k} &amp; thing{i}.</p>" for k in range(3))
    menu = "".join(f'<li><a href="/{i}{k}">Entry {k}</a>' for k in range(4))
    return (
        f'<html><body><div id="top"><ul>{menu}</ul></div><div id="x9"><h1>Title number {i}</h1><p>{notice}</p>{body}</div>'
        f'<div class="side-bar widget"><p>Lately {i}: a long sidebar text about many other things that nobody asked for, {i} of them</p></div>'
        f'<div id="comments"><div class="comment"><p>reader {i} says a lot more than all the paragraphs of the text say together, {"word " * 60}</p></div></div></body></html>'
    )


def test_hosts_without_semantic_elements(spark):
    rows = [(i, f"http://user@One.example:80/p{i}", site(i)) for i in range(9)]
    got = {r["page_id"]: r for r in templates.extract(pages_of(spark, rows)).collect()}
    for i in range(9):
        wanted = [f"Title number {i}", *[f"Paragraph {i * 7 + k} about subject{i}x{k} & thing{i}." for k in range(3)]]
        assert got[i]["text"] == "\n\n".join(wanted) and got[i]["n_constant"] == 1 and got[i]["host"] == "one.example"
    # the template decides: below the least number of pages, and for hosts of copies, the block stays
    few = templates.extract(pages_of(spark, rows[:3])).collect()
    assert all("All rights of this notice are kept." in r["text"] and r["n_template"] == 0 for r in few)
    copies = templates.extract(pages_of(spark, [(i, "http://one.example/", site(1)) for i in range(20)])).collect()
    assert len({r["text"] for r in copies}) == 1 and "Paragraph 7 about" in copies[0]["text"]


def test_hosts_dealt_by_salt_equal_hosts_sent(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", site(i)) for i in range(24)] + [(99, None, site(3)), (98, "http://h0.example/", None)]
    plain = sorted(templates.extract(pages_of(spark, rows)).collect(), key=str)
    assert plain == sorted(templates.extract(pages_of(spark, rows), templates.Template(sent_bytes=0, salts=3)).collect(), key=str)


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "", ""), (3, "not a url", "just text &lt;b&gt;  with\n\tspace"), (None, "http://a.example/", "<article>no id</article>"), (3, "http://a.example/", "<article>repeated"),
        (4, "http://a.example", "<article><p>one<p>two<br>lines<li>three<li>four</article><footer>f</footer>"), (5, "http://a.example", "<p>a < b &am &copy &#x41;&nbsp;&bogus;</p>"),
        (6, "//b.example/x", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"), (7, "http://c.example/", "<article>" + "word " * 200_000 + "</article>"),
        (8, "http://c.example/", '<main><h1>T</h1><p>in <span class="ad">buy</span> and out<p class="cookie-notice">we use them<p>more<script>var a="</p>"</script><!-- x --><form>name <input></form></main>'),
        (9, "http://c.example/", "<title>only</title><body>text of body<nav>menu"), (9, "http://c.example/", "<title>only</title><body>text of body<nav>menu"), (10, "http://c.example/", "<article></article>"),
        (11, "http://d.example/", "<article>a <!-- never ended"), (12, "http://d.example/", "<article>b<script>never ended"), (13, "http://d.example/", '<article><a href="x>broken</a> rest</article>'),
    ]
    df = pages_of(spark, rows).selectExpr("*", "1 as host", "'x' as text", "2 as blocks", "3 as n_chars", "4 as Template", "5 as dense")
    got = [(r["page_id"], r["text"]) for r in templates.extract(df).collect()]
    texts = {}
    for i, t in got:
        texts.setdefault(i, []).append(t)
    assert len(got) == len(rows) and texts[1] == texts[2] == [""] and texts[None] == ["no id"]
    assert sorted(texts[3]) == ["just text <b> with space", "repeated"]
    assert texts[4] == ["one\n\ntwo lines\n\nthree\n\nfour"] and texts[5] == ["a < b &am © A &bogus;"]
    assert texts[6] == ["deep"] and texts[7] == [("word " * 200_000).strip()]
    assert texts[8] == ["T\n\nin and out\n\nmore"] and texts[9] == ["text of body"] * 2 and texts[10] == [""]
    assert texts[11] == ["a"] and texts[12] == ["b"] and texts[13] == ["broken rest"]
    assert templates.extract(df.limit(0)).count() == 0


def test_vectors_orders_and_crossings(spark):
    """Tokens that stand equally often on each page, but in changing order, are no template; neither are classes that cross."""
    rows = [(i, "http://o.example/", "<html><body><i>" + (" aa bb " if i % 2 else " bb aa ") + "</i><article>" + f" w{i}" * (i + 1) + "</article></body></html>") for i in range(8)]
    made = templates.templates(pages_of(spark, rows).select(templates.host().alias("host"), "html")).first()
    assert "/html <body" in made["template"] and not [t for t in made["template"] if t.endswith((" aa", " bb"))]
    place = {1: (0, 0), 2: (0, 1), 3: (1, 0), 4: (1, 1)}
    assert templates.crossings([1, 3, 2, 4], place, {0: 2, 1: 2}) and not templates.crossings([1, 3, 4, 2, 1, 2, 3, 4], place, {0: 2, 1: 2})


@pytest.mark.parametrize("url, wanted", [("HTTP://U:p@Ab.Example.:8080/x", "ab.example"), ("//x.y", "x.y"), ("mailto:a@b", None), ("", None), (None, None), ("http:///p", None)])
def test_hosts(spark, url, wanted):
    assert spark.createDataFrame([(url,)], "url string").select(templates.host()).first()[0] == wanted


def test_roles():
    kinds = {"<nav>a</nav>": 1, "<article><header>a</header></article>": 2, "<header>a</header>": 1, "<div class='post-body'>a</div>": 2, "<section class='relatedPosts related'>a</section>": 1, "<body class='has-sidebar'>a": 0}
    for page, role in kinds.items():
        assert [b.role for b in html_pages.blocks(page, {})] == [role], page
