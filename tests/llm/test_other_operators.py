"""Operators 2, 4 and 8, the components helper and the pipeline."""

import math
import random

import corpus_pipeline
from tonality.llm import html_text, topk, url_filter
from tonality.llm.components import connected_components

PAGE = ("<html><head><title>x</title></head><body><nav><a>menu</a></nav><div class='ad box'>buy</div><article><h1>A &amp; B</h1>"
        "<p>one <b>two</b>\n three<p>four<div class=comments>me too</div><script>if (a<b) {}</script></article><footer>f</footer>")


def test_html_text_and_wrapper(spark):
    rows = [(1, "http://a.b/1", PAGE), (2, None, None), (3, "x", ""), (4, "http://c/1", "<p>only</p> tail"), (1, "http://a.b/1", PAGE)]
    rows += [(10 + i, f"http://t.u/{i}", f"<body><p>Same on all</p><p>text {i}</p></body>") for i in range(5)]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    out = {r.page_id: r for r in html_text.extract(pages, per_host=100).collect()}
    assert out[1].text == "A & B one two three four" and out[1].n_chars == 24
    assert (out[2].text, out[3].text, out[4].text) == ("", "", "only tail")
    assert out[12].text == "text 2"
    assert html_text.extract(pages.filter("false")).count() == 0
    assert html_text.infer(["<ul><li>a</li><li>b</li></ul>", "<ul><li>a</li><li>b</li></ul><p>c</p>"]) == \
        "<ul> (<li> # </li>)+ </ul> (<p> # </p>)?"


def test_top_k_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(40)] + [(400, None), (401, [float("nan")] * 8), (402, [None] * 8), (403, [1.0, 2.0]), (500, [2.0, 1.0]), (None, [1.0] * 8)]
    data = topk.prepared(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, id int"), "vec_id", "embedding")
    got = topk.top_k(data, data.filter("id % 100 = 0"))
    out = sorted(tuple(r) for r in got.collect())
    held = {r.id: list(r.v) for r in data.collect()}
    assert 401 not in held and all(x == math.floor(x) for v in held.values() for x in v)
    want = []
    for q in sorted(i for i in held if i % 100 == 0):
        score = sorted((-int(sum(a * b for a, b in zip(held[q], v))), i) for i, v in held.items() if i != q and len(v) == len(held[q]))
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(score[:10])]
    assert out == want
    assert topk.top_k(data.filter("false"), data.filter("false")).count() == 0


def test_url_rules_and_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "http://A.example.net/en/x?q#f", None), (2, "https://b.net/x", ""), (3, "http://example.com/de/", ""), (4, "http://x.org/fr/", ""),
            (5, "http://alias.example.com/a", link.format("http://b.net/x")), (6, "http://two.example.com/a", link.format("http://alias.example.com/a")),
            (7, "http://three.example.com/a", link.format("http://x.org/fr/")), (8, "http://three.example.com/a", link.format("http://b.net/q")),
            (9, None, None), (10, "no scheme", "<p>"), (11, "http://net", ""), (12, "ftp://q.net/", "")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert out[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and out[2] == ("b.net", "/x", "net/", "block")
    assert out[3][2:] == ("example.com/de/", "block") and out[4][2:] == ("org/fr/", "allow")
    assert [out[i][3] for i in (5, 6, 7, 8)] == ["block", "block", "allow", "allow"]
    assert out[9] == ("", "", None, "allow") and out[10] == ("", "", None, "allow")
    assert out[11] == ("net", "", None, "allow") and out[12][3] == "block"
    assert url_filter.judge_urls(pages.filter("false")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(50)}}


def test_pipeline_on_a_small_table(spark, docs, tmp_path):
    rng = random.Random(6)
    text = lambda n: " ".join(f"t{rng.choice('abcdefgh')}{rng.randrange(5000)}" for _ in range(n))
    passage, copied = text(30), text(80)
    rows = [(i, text(60), "en", "a") for i in range(40)] + [(50, copied, "en", "a"), (51, copied, "en", "b"),
            (52, f"{text(40)} {passage}", "en", "b"), (53, None, "en", "b"), (54, "123 456", "en", "b"), (55, text(50) + " a.b@c.example.com", "en", None)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(range(40)) | {50, 55}
    frame = docs(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == docs([]).columns, name
