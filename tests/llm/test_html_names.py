"""Operator 2: names of elements and implied ends of dropped ones."""

import pytest

from tonality.llm.html_text import main_text


@pytest.mark.parametrize("html, text", [
    ('<body class="has-sidebar"><p>one</p></body>', "one"),
    ('<body class=sidebar><article class="post comments-open comments"><p>one</p></article>', "one"),
    ('<main class="menu-open menu"><p>one</p></main>', "one"),
    ('<div class="no-comments"><p>one</p></div><div class="site-footer">f</div><div class=cookie-banner>c</div>', "one"),
    ("<article><p class=notice>gone<p>one<p>two</article>", "one two"),
    ("<article><p class=notice>gone <b>too<div>one</div></article>", "one"),
    ("<article><ul><li class=share>gone<ul><li>gone</ul><li>one</ul><p>two</article>", "one two"),
    ("<article><ul><li class=share><div>gone<li>one</ul></article>", "one"),
    ("<article><ul><li>one<p class=ad>gone<li>two</ul></article>", "one two"),
    ("<article><section><div class=ad>gone</section><p>one</article>", "one"),
    ("<html><head><title>x</title><body><p>one</p>", "one"), ("<head><title>x</title><p>one</p>", "one"),
    ("<article><p>one<div class=ad>gone</p>gone</div><p>two</article>", "one two"),
    ("<article><table><tr><td class=ad><div>gone<td>one<tr><td>two</table></article>", "one two"),
    ("<article><aside><p>gone<p>gone</aside>one</article>", "one"),
])
def test_dropped_names_and_ends(html, text):
    assert main_text(html) == text
