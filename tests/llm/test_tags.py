"""The tag scan: linear on broken pages, and what it does not take for tags."""

import time

import pytest

from tonality.llm import html_text, url_filter
from tonality.llm.tags import tags

BROKEN = ["<a ", "<a \"", "<a '>", "<script ", "<script>", "<!--", "<link ", "<link \"x' ", "<p x=\"", "</", "<!", "<a x='\">", "< ", "<meta http-equiv=refresh "]


@pytest.mark.parametrize("piece", BROKEN)
def test_broken_pages_of_5_mb(piece):
    page = "canonical http-equiv" + piece * (5_000_000 // len(piece)) + "<p>end"
    for work in (html_text.main_text, lambda p: list(url_filter.references(p))):
        started = time.time()
        work(page)
        assert time.time() - started < 15


def test_one_tag_of_1_mb(spark):
    page = "<link " + "x" * 1_000_000 + " rel=canonical href='http://b.c/'>"
    pages = spark.createDataFrame([(1, "http://a.b/", page)], "page_id long, url string, html string")
    assert [tuple(r) for r in url_filter.alias_edges(pages).collect()] == [("http://a.b/", "http://b.c/")]


def test_quotes_and_ends():
    html = "a<b x='>' y=\">\">c</B>d<e z=\"open>f <g"
    assert [(html[t.start:t.end], t.name, t.closing) for t in tags(html)] == [
        ("<b x='>' y=\">\">", "b", False), ("</B>", "b", True), ("<e z=\"open>", "e", False)]


@pytest.mark.parametrize("html", [
    "<!-- <link rel=canonical href='http://z.net/'> -->", "<script>var x = \"<link rel=canonical href='http://z.net/'>\"</script>",
    "<textarea><meta http-equiv=refresh content='0;url=http://z.net/'></textarea>", "<link rel=notcanonical href='http://z.net/'>",
    "<link data-rel=canonical href='http://z.net/'>", "<link rel=canonical data-href='http://z.net/'>"])
def test_no_edges(html):
    assert list(url_filter.references(html)) == []


def test_one_node_for_equal_addresses(spark):
    urls = ["http://a.com", "http://a.com/", "http://A.com:80/#x", "https://a.com:443", "http://a.com:443", "http://a.com/?q"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    nodes = [r.n for r in df.select(url_filter._node(df.u).alias("n")).collect()]
    assert nodes == ["a.com/"] * 4 + ["a.com:443/", "a.com/?q"]


@pytest.mark.parametrize("name", ["id=header", 'class="reader-comments"', 'class="related-posts"', 'class="ad-slot"', 'class="share-buttons"',
                                  'class="cookie-policy"', 'class="newsletter-signup"', 'class="masthead"', 'class="pagination"',
                                  'class="post-comments"', 'class="reply"', 'id="site_header"'])
def test_names_by_word(name):
    assert html_text.main_text(f"<body><div {name}>gone</div><p>one</p></body>") == "one"
    assert html_text.main_text(f"<article><p>one</p><div {name}>gone</div></article>") == "one"


@pytest.mark.parametrize("name", ["class=has-sidebar", 'class="comments-open"', 'class="article-header"', 'class="loads shared-ness reader"'])
def test_names_that_stay(name):
    assert html_text.main_text(f"<article><div {name}>one</div></article>") == "one"
