import json

import pytest
from pyspark.sql import functions as F

from leafmill.functions import html as H
from leafmill.functions.text import decode_entities
from leafmill.operators import documents as D
from leafmill.operators import extract as X
from leafmill.operators import nodes as N
from leafmill.operators.scrape import scrape, scrape_get, select_formats

PAGE = """<!DOCTYPE html><html lang=en><head><title>T &amp; x</title><meta name="description" content='A d'>
<link rel="shortcut icon" href=/f.ico><meta charset=UTF-8></head><body><div id=main class="a b"><div><p>one<p>two
<img src="i.png" alt="I"><img src='/r.png'><img alt=z src=//cdn.x/q.gif><a href=../up?q=1>up</a>
<a href='mailto:joe@ex.org'>m</a> ann@ex.org</div><span>s</span></div><h2>Two</h2><h3 class=k>Three</h3>
<a data-href="/no">x</a><a href="#top">top</a><a href="?p=2">next</a><a href="https://o.org/z">o</a></body></html>"""
URL = "https://e.org/a/b/c.html?x=1#f"


@pytest.fixture
def page(spark):
    return spark.createDataFrame([(1, URL, PAGE)], "page_id long, url string, html string")




def test_all_formats(page, rows):
    (doc,) = rows(X.extract(page, X.TEXT_FORMATS, metadata=True))
    assert doc["raw_html"] == PAGE and "<p>one" in doc["html"]
    assert doc["links"] == [
        "https://e.org/a/up?q=1", "https://e.org/a/b/c.html?x=1#top", "https://e.org/a/b/c.html?p=2", "https://o.org/z",
    ]
    assert doc["images"] == ["https://e.org/a/b/i.png", "https://e.org/r.png", "https://cdn.x/q.gif"]
    assert doc["emails"] == ["ann@ex.org", "joe@ex.org"]
    for part in ("![I](i.png)", "![](/r.png)", "[up](../up?q=1)", "## Two", "### Three", "one\n\ntwo"):
        assert part in doc["markdown"]
    meta = doc["metadata"]
    assert meta["title"] == "T & x" and meta["description"] == "A d" and meta["language"] == "en"
    assert meta["favicon"] == "https://e.org/f.ico" and meta["content_type"] == "text/html; charset=utf-8"
    assert meta["status_code"] == 200 and meta["url"] == URL


def test_empty_results_are_arrays(spark, rows):
    bare = spark.createDataFrame([(1, "https://e.org", "<p>x</p>")], "page_id long, url string, html string")
    (doc,) = rows(X.extract(bare, ("links", "images", "emails"), metadata=True))
    assert doc["links"] == [] and doc["images"] == [] and doc["emails"] == []
    assert doc["metadata"]["title"] is None and doc["metadata"]["description"] is None


def test_markdown_blocks(spark):
    cases = {
        "<h1>A</h1><p>b <b>c</b> <em>d</em><br>e</p>": "# A\n\nb **c** *d*\ne",
        "<ul><li>x</li><li>y &lt;z&gt;</li></ul>": "- x\n- y <z>",
        "<script>var a='<p>no</p>'</script><style>p{}</style><!-- n -->&amp;amp;": "&amp;",
        "<p>  many \t blanks  </p>\n\n\n<p>next</p>": "many blanks\n\nnext",
    }
    for html, want in cases.items():
        got = spark.range(1).select(H.markdown(H.clean_html(F.lit(html))).alias("m")).first()["m"]
        assert got == want, html


def fields(spark, html, rules):
    page = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    out = {}
    for r in N.extract_fields(page, rules).orderBy("field", "idx").collect():
        out.setdefault(r["field"], []).append(r["value"])
    return out


def test_selectors(spark):
    html = (
        "<div class=x><p>t<img id=1 src=a><br/><span><img id=2></span></p><ul><li>a<ul><li>b</li></ul></li><li>c</ul>"
        "<b>z<i>q</i></div><div>w</div>"
    )
    want = {
        "p > img": ["1"], "p img": ["1", "2"], "div > ul > li": ["ab", "c"], "li > ul > li": ["b"],
        "ul li": ["ab", "b", "c"], "b": ["zq"], "div > b": ["zq"], "b > i": ["q"], "*[id=2]": [""],
        "div.x, i": ["tabczq", "q"], "div": ["tabczq", "w"],
    }
    rules = {s: {"selector": s, "multiple": True, **({"attr": "id"} if "img" in s else {})} for s in want}
    rules[".x div"] = {"selector": ".x div", "multiple": True}
    rules["first li"] = "li"
    assert fields(spark, html, rules) == {**want, "first li": ["ab"]}


def test_broken_nesting(spark):
    # A missing close runs to the close around it; a `p` to the next `p`; a stray close changes nothing.
    html = "</p><div><p>one<p>two</div></b><section><b>x</section><i>y<u>z</i>w</u> tail<p>end"
    got = fields(
        spark, html, {k: {"selector": k, "multiple": True} for k in ("p", "b", "div", "section", "i", "u")}
    )
    assert got == {"p": ["one", "two", "end"], "b": ["x"], "div": ["onetwo"], "section": ["x"], "i": ["yz"], "u": ["zw"]}


def test_attributes(spark, rows):
    page = spark.createDataFrame(
        [(1, "u", """<a HREF="x&amp;y" class='k  l' class="m" hidden data-n=5>t</a>""")],
        "page_id long, url string, html string",
    )
    node = [r for r in rows(N.page_nodes(page)) if r["kind"] == "open"][0]
    assert node["attrs"] == {"href": "x&y", "class": "k  l", "hidden": "", "data-n": "5"}
    assert node["classes"] == ["k", "l"]


def test_fields_json_and_bad_selector(page, rows):
    rules = {"h": "h2", "p": {"selector": "#main p", "multiple": True}, "none": "table", "src": {"selector": "img", "attr": "src"}}
    (got,) = rows(N.fields_json(N.extract_fields(page, rules), rules))
    assert json.loads(got["json"]) == {"h": "Two", "p": ["one", "two up m ann@ex.org"], "none": None, "src": "i.png"}
    with pytest.raises(ValueError):
        N.extract_fields(page, {"x": "p:first-child"})


def test_scrape_copies_and_formats(spark, rows):
    pages = spark.createDataFrame(
        [(1, "https://a.org/", "<h1>old</h1>"), (2, "https://a.org/", "<h1>new</h1>"), (3, "https://b.org/", "<p>b")],
        "page_id long, url string, html string",
    )
    requests = spark.createDataFrame(
        [(1, "https://a.org/", ["markdown"]), (2, "https://a.org/", ["json", "links"]), (3, "https://c.org/", ["html"]),
         (4, "https://b.org/", [])],
        "request_id long, url string, formats array<string>",
    )
    docs = rows(scrape(requests, pages, rules={"head": "h1"}), "request_id")
    assert [d["success"] for d in docs] == [True, True, False, True]
    assert docs[0]["markdown"] == "# new" and docs[0]["links"] is None and docs[0]["json"] is None
    assert json.loads(docs[1]["json"]) == {"head": "new"} and docs[1]["links"] == [] and docs[1]["markdown"] is None
    assert docs[2]["error"] == "page not found" and docs[2]["metadata"] is None
    assert docs[3]["html"] is None and docs[3]["metadata"]["credits_used"] == 1.0
    hot = rows(scrape(requests, pages, rules={"head": "h1"}, heavy={"https://a.org/": 3_000_000}), "request_id")
    assert hot == docs
    assert [d["markdown"] for d in rows(scrape_get(requests.drop("formats"), pages), "request_id")] == ["# new", "# new", None, "b"]


def test_select_formats(page):
    docs = X.extract(page, ("markdown", "links"))
    assert select_formats(docs, ["links"]).columns == ["page_id", "url", "links"]


def test_loader_records(spark, rows):
    docs = spark.sql(
        "select 'u' url, '' markdown, '<p>' html, named_struct('title', 't', 'url', 'final', 'favicon', null) metadata"
    )
    (lang,) = rows(D.to_loader_documents(docs, user={"source": "mine", "tag": "x"}))
    assert lang["page_content"] == "<p>"
    assert lang["metadata"] == {"source": "u", "tag": "x", "title": "t", "url": "final"}
    (llama,) = rows(D.page_records(docs, key="url", allow_html=False).select("page_content", "metadata"))
    assert llama == {"page_content": "", "metadata": {"url": "final", "title": "t"}}
    with pytest.raises(ValueError):
        D.to_loader_documents(docs, "crawl")


def test_odd_markup(spark, rows):
    html = (
        "<h1>1 < 2 and 3 > 2</h1><a title=\"see href=bad\" href=\"/good\">a&#8217;b</a><a href='HTTP://Up.org/'>u</a>"
        "<a href=\"\n/nl \">n</a><table><tr><td>alpha</td><td>beta</td></tr></table><dl><dt>t</dt><dd>d</dd></dl>"
        "<p>caf&eacute; &mdash; a&#64;b.org &#x20AC; &amp;lt; &#xD800; &#99999999; &apos;</p><img data-src=no alt='src=x' src=i.png>"
    )
    page = spark.createDataFrame([(1, "https://h.org/d/p", html)], "page_id long, url string, html string")
    (doc,) = rows(X.extract(page, X.TEXT_FORMATS))
    assert [u.lower() for u in doc["links"]] == ["https://h.org/good", "http://up.org/", "https://h.org/nl"]
    assert doc["images"] == ["https://h.org/d/i.png"] and doc["emails"] == ["a@b.org"]
    text = doc["markdown"]
    assert "# 1 < 2 and 3 > 2" in text and "a’b" in text and "alpha beta" in text.replace("  ", " ") and "td" not in text
    assert "café — a@b.org € &lt; &#xD800; &#99999999; '" in text


def test_tags_without_the_attribute_are_read_fast(spark):
    long = "<a " + "x" * 20_000 + ">" + "<a " + "b=c " * 5_000 + ">"
    df = spark.createDataFrame([(long,)], "t string").select(H.attribute(F.col("t"), "href").alias("v"))
    assert df.first()["v"] is None


def test_base_element(spark):
    cases = [
        ('<base href="/d/"><a href="x">', ["https://s.test/d/x"]),
        ('<BASE><base target=a><base href="https://o.test/p/q"><a href="x"><a href="/y"><a href="#z">', ["https://o.test/p/x", "https://o.test/y", "https://o.test/p/q#z"]),
        ('<base href=""><a href="x">', ["https://s.test/a/x"]),
        ('<a href="x"><basefont href="/no/">', ["https://s.test/a/x"]),
        (None, None),
    ]
    df = spark.createDataFrame([(i, "https://s.test/a/b", h) for i, (h, _) in enumerate(cases)], "page_id int, url string, html string")
    got = {r.page_id: r.links for r in X.extract(df, ("links",), ("page_id",)).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_references(spark):
    cases = {
        "&oslash;&sup2;&frac12;&Eacute;&bull;": "ø²½É•", "&#150;&#x80;&#129;": "–€\x81", "&amp;lt; &amp;#39;": "&lt; &#39;", "&&lt;&": "&<&",
        "a&nbsp;b &nosuch; &lt &#0; &#xD800; &#39;&apos;": "a b &nosuch; &lt &#0; &#xD800; \'\'", "&#x1F600;&#128512;x": "\U0001f600\U0001f600x", "": "",
        "&lt;b&gt;&;&#;": "<b>&;&#;",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r.t: r.x for r in df.select("t", decode_entities(F.col("t")).alias("x")).collect()}
    assert got == {**cases, None: None}
