"""Operator 2: wrappers of many different pages, and pages matched against them."""

import random

import pytest

from tonality.llm import html_text
from tonality.llm.html_text import bounded, expression, generalise, generalised, infer, main_text, page_wrapper, places, tree

SCHEMA = "page_id long, url string, html string"


def some_page(rng, depth=3):
    return "".join(f"<{n}>{rng.choice(['', 'x', some_page(rng, depth - 1) if depth else 'y'])}</{n}>"
                   for n in rng.choices(["div", "section", "h2", "blockquote", "pre"], k=rng.randrange(6)))


def unplaced(children, wrapper):
    """Children that no part of the wrapper takes, where it holds their element."""
    if wrapper is None:
        return 0
    at = places([c[0] for c in children], wrapper[1])
    return at.count(-1) + sum(unplaced(c[1], wrapper[0][c[0]]) for c, i in zip(children, at) if i >= 0 and c[0] != "#")


def test_texts_are_told_apart_by_slot(spark):
    """The first div says the same on all pages; the last one varies and says that too on one page."""
    rows = [(i, f"http://a.b/{i}", f"<body><div>Home</div><p>text {i}</p><div>{'Home' if i == 2 else i}</div></body>") for i in range(5)]
    pages = spark.createDataFrame(rows, SCHEMA)
    out = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert out == {i: f"text {i} " + ("Home" if i == 2 else str(i)) for i in range(5)}
    assert [r.wrapper for r in html_text.wrappers(pages).collect()] == ["<body> <div> # </div> <p> # </p> <div> # </div> </body>"]


def test_needed_parts_decide_where_a_text_belongs(spark):
    """The div of page 4 is the footer that all pages have, not the optional one before the text."""
    rows = [(i, f"http://a.b/{i}", f"<div>top {i}</div><p>text {i}</p><div>end</div>") for i in range(3)]
    rows += [(3, "http://a.b/3", "<p>text 3</p><div>end</div>"), (4, "http://a.b/4", "<div>end</div>")]
    out = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {0: "top 0 text 0", 1: "top 1 text 1", 2: "top 2 text 2", 3: "text 3", 4: ""}
    wrapper = page_wrapper(tree("<div>a</div><p>b</p><div>c</div>"))
    wrapper = generalise(wrapper, page_wrapper(tree("<p>b</p><div>c</div>")))
    assert places(["div"], wrapper[1]) == [2] and places(["div", "p"], wrapper[1]) == [0, 1]


def test_every_page_fits_and_chains_stay_short():
    rng = random.Random(3)
    pages = [some_page(rng) for _ in range(300)]
    wrapper = generalised([page_wrapper(tree(p)) for p in pages])
    assert all(unplaced(tree(p), wrapper) == 0 for p in pages)

    def longest(w):
        return max([len(w[1]), *map(longest, w[0].values())]) if w else 0
    assert 3 < longest(wrapper) <= 12  # twice the names, and text
    assert 100 < sum(html_text._sizes(wrapper)) <= html_text.NODES
    narrow = bounded(wrapper, 40)
    assert sum(html_text._sizes(narrow)) <= 40 and "..." in expression(narrow)
    assert all(unplaced(tree(p), narrow) == 0 and main_text(p, narrow) == main_text(p) for p in pages)


def test_a_host_of_many_wrappers_is_generalised_in_groups(spark):
    rng = random.Random(5)
    pages = sorted({some_page(rng) for _ in range(120)})
    assert len({str(page_wrapper(tree(p))) for p in pages}) > 3 * html_text.FAN
    rows = [(i, f"http://a.b/{i}", p) for i, p in enumerate(pages)] + [(-1, "http://c.d", "<p>one</p>")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for n in (2, 7):  # the same however pages are dealt
        found[n] = {r.host: r.wrapper for r in html_text.host_wrappers(frame.repartition(n)).collect()}
    assert found[2] == found[7] and set(found[2]) == {"a.b", "c.d"}
    assert all(unplaced(tree(p), html_text._read(found[2]["a.b"])) == 0 for p in pages)
    out = {r.page_id: r.text for r in html_text.extract(frame).collect()}
    assert out == {i: main_text(p) for i, _, p in rows}


def test_wide_wrappers_are_cut_and_lose_no_text():
    page = "".join(f"<{a}><{b}><{c}>{a}</{c}></{b}></{a}>" for a in ("div", "section") for b in ("ul", "pre") for c in ("h2", "h3"))
    wrapper = page_wrapper(tree(page))
    assert expression(bounded(wrapper, 7)) == "(<div> (<ul> ... </ul>)? (<pre> ... </pre>)? </div>)+ (<section> (<ul> ... </ul>)? (<pre> ... </pre>)? </section>)+"
    assert expression(bounded(wrapper, 1)) == "(<div> ... </div>)+ (<section> ... </section>)+"
    assert expression(generalise(bounded(wrapper, 1), wrapper)) == expression(bounded(wrapper, 1))
    assert main_text(page, bounded(wrapper, 7)) == main_text(page, wrapper) == main_text(page)
    deep = "<div>" * 500 + "a<p>b" + "</div>" * 500 + "c"
    assert main_text(deep, page_wrapper(tree(deep))) == "a b c"


@pytest.mark.parametrize("pages, want", [
    (["<p>a</p><ul></ul><p>a</p><ul></ul><p>a</p>"], "((<p> # </p>)? (<ul> </ul>)?)+"),
    (["<h1>a</h1><p>b</p>", "<p>b</p><h2>c</h2>"], "(<h1> # </h1>)? <p> # </p> (<h2> # </h2>)?"),
    (["<div><p>a</p></div><p>b</p><div>c</div>"], "<div> (<p> # </p>)? (#)? </div> <p> # </p> <div> = </div>"),
    (["<p>a</p>", ""], "(<p> # </p>)?"), ([""], ""), ([], ""),
    (["<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>"], "<dl> ((<dd> # </dd>)? (<dt> # </dt>)?)+ </dl>"),
])
def test_expressions(pages, want):
    assert infer(pages) == want


def test_many_parts_take_linear_time():
    page = "<p>a</p><ul><li>b</ul><x>c</x><h2>d</h2>" * 20_000
    wrapper = page_wrapper(tree(page))
    assert len(wrapper[1]) == 1 and len(main_text(page, wrapper).split()) == 80_000
