"""Tags of a page in one linear scan, whatever the page holds.

A tag runs from ``<`` and a letter (or ``</``) to the first ``>`` outside quotes. A quote
that nothing closes counts as any other character, and once a tag's quotes reach the
page's end, quotes no longer count in the rest of the page. ``<`` without such an end is text. Comments,
declarations and the contents of raw elements (scripts and the like) hold no tags.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

RAW = frozenset(("script", "style", "noscript", "template", "textarea", "svg"))
OPENING = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
STOP = re.compile(r"[>\"']")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


class Tag(NamedTuple):
    start: int
    end: int
    name: str          # lower case; empty for a comment, a declaration or a raw element
    closing: bool
    attributes: str


def tags(html: str, raw: frozenset[str] = RAW) -> Iterator[Tag]:
    last = {c: html.rfind(c) for c in ">\"'"}
    quotes = True
    at = 0
    while m := OPENING.search(html, at):
        start, at = m.start(), m.end()
        if m[2] is None:
            if m[0] == "<!--":
                end = html.find("-->", at)
                end = len(html) if end < 0 else end + 3
            elif at > last[">"]:
                continue
            else:
                end = html.index(">", at) + 1
            yield Tag(start, end, "", False, "")
            at = end
            continue
        if at > last[">"]:
            return
        end, i = -1, at
        while quotes and end < 0:
            s = STOP.search(html, i)
            if s is None:
                quotes = False
            elif s[0] == ">":
                end = s.end()
            else:
                i = s.end() if s.start() == last[s[0]] else html.index(s[0], s.end()) + 1
        if end < 0:
            end = html.index(">", at) + 1
        name = m[2].lower()
        if name in raw and not m[1]:
            stop = RAW_END[name].search(html, end)
            end = stop.end() if stop else len(html)
            yield Tag(start, end, "", False, "")
        else:
            yield Tag(start, end, name, bool(m[1]), html[at:end - 1])
        at = end
