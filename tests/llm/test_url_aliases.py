"""Operator 8: every form of an alias edge."""

from tonality.llm import url_filter


def test_every_link_and_every_form(spark):
    canon, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="Refresh" content="0; url={}">'
    rows = [(1, "http://x.com/d/p", canon.format("http://a.com/1") + canon.format("http://b.com/2")),
            (2, "http://x.com/e/p", refresh.format("http://a.com/3") + "\n" + refresh.format("http://b.com/4")),
            (3, "http://x.com/d/rel", canon.format("page2.html")), (4, "http://x.com/d/up", canon.format("../x")),
            (5, "http://x.com/d/q", refresh.format("?id=3")), (6, "http://x.com/d/amp", canon.format("/a?page=2&amp;ref=x")),
            (7, "http://x.com/d/host", canon.format("//c.com/y")), (8, "http://x.com/d/b", "<base href='/z/'>" + canon.format("w")),
            (9, "http://x.com/r", """<meta content="5;URL='http://d.com/go?url=http://e.com/'" http-equiv=refresh>"""),
            (10, "http://x.com/s", "<LINK href=t.html rel=canonical>"), (11, "http://x.com/bad", canon.format("http://[x")),
            (12, "http://x.com/no", '<meta http-equiv="Content-Type" content="url=u"><link rel=icon href=v>'), (13, None, canon.format("q"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {(r.u, r.v) for r in url_filter.alias_edges(pages).collect()}
    x = "http://x.com/"
    assert out == {(x + "d/p", "http://a.com/1"), (x + "d/p", "http://b.com/2"), (x + "e/p", "http://a.com/3"), (x + "e/p", "http://b.com/4"),
                   (x + "d/rel", x + "d/page2.html"), (x + "d/up", x + "x"), (x + "d/q", x + "d/q?id=3"), (x + "d/amp", x + "a?page=2&ref=x"),
                   (x + "d/host", "http://c.com/y"), (x + "d/b", x + "z/w"), (x + "r", "http://d.com/go?url=http://e.com/"), (x + "s", x + "t.html")}
    ruled = [(1, "http://x.com/a?page=2&ref=x", ""), (2, "http://k.net/1", canon.format("http://x.com/a?page=2&amp;ref=x"))]
    judged = url_filter.judge_urls(spark.createDataFrame(ruled, "page_id long, url string, html string"))
    assert {r.page_id: r.verdict for r in judged.collect()} == {1: "block", 2: "block"}
