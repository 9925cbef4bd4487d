"""Operator 2: templates and wrappers over all pages of a host."""

from tonality.llm import html_text


def test_templates_count_all_pages(spark):
    rows = [(i, f"http://big.u/{i}", f"<body><p>Same</p><p>text {i}</p>{'' if i == 77 else '<p>Nearly</p>'}</body>") for i in range(120)]
    rows += [(1000 + i, "http://copies.u/1", f"<body><p>Same</p><p>copy {i % 3}</p></body>") for i in range(90)]
    rows += [(2000 + i, "http://two.u/1", f"<body><p>Same</p><p>two {i % 2}</p></body>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    out = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert all(out[i] == f"text {i}" + ("" if i == 77 else " Nearly") for i in range(120))
    assert all(out[1000 + i] == f"copy {i % 3}" for i in range(90))
    assert all(out[2000 + i] == f"Same two {i % 2}" for i in range(30))
    found = {r.host: r.wrapper for r in html_text.wrappers(pages).collect()}
    assert found["copies.u"] == found["two.u"] == "<body> (<p> # </p>)+ </body>" and found["big.u"] == found["two.u"]
