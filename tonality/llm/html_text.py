"""HTML main text by wrapper inference.

Each host gets a wrapper: a union-free regular expression over elements and text slots
that fits all its different pages.

1. A page's elements and texts are a tree; the children of an element are a chain of parts, and
   adjacent children of one name become ``(...)+``. That is the page's own wrapper.
2. Wrappers of a host are generalised pairwise, in groups of about ``FAN`` dealt by their digest, until
   one is left. Two chains are aligned; parts without a partner become ``(...)?``. A name that stands in more
   than two parts of a chain makes them one part, ``((a)? (b)?)+``, so a chain is no longer than twice the names;
   elements of one name in a chain have one content.
   A wrapper of more than ``NODES`` nodes is cut at the depth where it has no more; texts below
   belong to the deepest element it holds.
3. Every page is matched against its host's wrapper: each text gets the slot it fills. Of all ways
   to match, the one that leaves out the fewest needed parts counts, leftmost on ties.
4. A slot's text is fixed where all different pages of the host (three or more) have it in that slot,
   counted over all pages by digest. Everything else in a slot varies and is what the wrapper extracts.

A page's main text is the text of its ``article`` or ``main`` elements, or if it
has neither the varying text of all its slots, without menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments. Character references are decoded, white
space inside a block becomes one space, and blocks are joined by one space. All pages are read whole.

Defined results: null or empty html gives an empty text; a null url or one without host
belongs to the host '' and has its own wrapper; unclosed elements end with the page;
repeated rows are extracted alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import written
from tonality.llm.tags import tags
from tonality.llm.url_filter import host_of

LEAST_PAGES = 3
FAN = 16      # wrappers generalised in one group
NODES = 2000  # of a wrapper
DEPTH = 32    # of a page's tree; deeper texts belong to the element at this depth
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav footer aside form button select iframe dialog".split())
# Words of a class, id or role that mark something other than main text.
DROPPED_NAMES = frozenset("ad ads advert adverts advertisement sponsor sponsored promo banner sidebar menu nav navbar "
                          "navigation breadcrumb breadcrumbs footer comment comments disqus respond cookie cookies consent "
                          "notice notices alert newsletter subscribe popup modal share sharing social related widget "
                          "pagination pager reply replies".split())
# Words of names that only say whether such a part is there or shown: "no-comments", "menu-open".
STATES = frozenset("has have no not with without is open opened closed enabled disabled hidden shown count".split())
# A name of these words alone is a page's header; an article's own header has its title.
PAGE_HEADER = frozenset("header masthead site page top global main wrapper wrap container inner".split())
MAIN = frozenset(("article", "main"))
NEVER_DROPPED = MAIN | {"html", "body"}  # by name
# Elements that end where one of these opens (HTML's optional end tags).
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr li dt dd main menu nav ol p pre search section table ul".split())
TABLE_PARTS = frozenset("tbody thead tfoot tr td th".split())
ENDED_BY = {"p": ENDS_P, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
            "optgroup": {"optgroup"}, "td": TABLE_PARTS, "th": TABLE_PARTS, "tr": TABLE_PARTS - {"td", "th"},
            "tbody": {"tbody", "thead", "tfoot"}, "thead": {"tbody", "thead", "tfoot"}, "tfoot": {"tbody", "thead", "tfoot"}}
IN_HEAD = frozenset("base link meta noscript script style template title".split())
# Names of elements that a wrapper tells apart; the others are one name.
NAMES = (ENDS_P | TABLE_PARTS | DROPPED | MAIN).union(
    "html body head caption colgroup legend optgroup option summary picture video audio canvas object map ruby rt".split())
OTHER = "other"
TEXT = "#"


def _marks(token: str) -> bool:
    """Whether a whole class, id or role names something other than main text."""
    words = {w for w in re.split(r"[^a-z]+", token) if w}
    if words & STATES:
        return False
    return bool(words & DROPPED_NAMES) or (bool(words & {"header", "masthead"}) and words <= PAGE_HEADER)


def ended(stack: list[str], name: str) -> int | None:
    """Where the elements begin that end when ``name`` opens, if any do."""
    if "head" in stack and name not in IN_HEAD:
        return stack.index("head")
    at = None
    for i in range(len(stack) - 1, -1, -1):
        if name in ENDED_BY.get(stack[i], ()):
            at = i
            if stack[i] != "p" and name not in TABLE_PARTS:
                break
        elif stack[i] == "table" or (name not in TABLE_PARTS and stack[i] not in INLINE
                                     and not (name in ("li", "dt", "dd") and stack[i] in ("address", "div"))):
            break
    return at


def tokens(html: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, dropped): kind is text, open or close; value the text or tag name."""
    at = 0
    for tag in tags(html):
        if tag.start > at:
            yield "text", html[at:tag.start], False
        at = tag.end
        if tag.closing:
            yield "close", tag.name, False
        elif tag.name:
            marked = tag.name not in NEVER_DROPPED and any(
                _marks(w) for a in ATTRIBUTE.findall(tag.attributes) for w in "".join(a).lower().split())
            yield "open", tag.name, tag.name in DROPPED or marked
    if at < len(html):
        yield "text", html[at:], False


def tree(html: str | None) -> list[tuple]:
    """The page's elements and texts in page order: (name, children) and (TEXT, text, inside article or main).
    Dropped elements have no children, inline elements are part of the text."""
    root: list[tuple] = []
    nodes = [root]  # children of the elements of ``path``, down to DEPTH
    parts: list[str] = []
    path: list[str] = []
    skipped: list[str] = []  # the dropped element and those open in it
    main = 0

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            nodes[-1].append((TEXT, text, main > 0))

    def opened(name: str) -> list[tuple]:
        children: list[tuple] = []
        nodes[-1].append((name if name in NAMES else OTHER, children))
        return children

    def closed(at: int) -> None:
        del path[at:]
        del nodes[at + 1:]

    for kind, value, dropped in tokens(html or ""):
        if skipped:
            if kind == "text":
                continue
            if kind == "open":
                at = ended(path + skipped, value)
                if at is None or at > len(path):
                    if at is not None:
                        del skipped[at - len(path):]
                    if value not in VOID:
                        skipped.append(value)
                    continue
            elif value in skipped:
                del skipped[len(skipped) - 1 - skipped[::-1].index(value):]
                continue
            elif value not in path:
                continue
            # The dropped element ends here without its own end tag.
            skipped.clear()
        if kind == "text":
            parts.append(value)
            continue
        if value not in INLINE:
            flush()
        if kind == "open":
            if (at := ended(path, value)) is not None:
                closed(at)
            if value in VOID:
                continue
            # A header inside the article holds its title.
            if dropped or (value == "header" and not main):
                flush()
                if value not in INLINE and len(path) < DEPTH:
                    opened(value)
                skipped.append(value)
                continue
            main += value in MAIN
            if value not in INLINE:
                if len(path) < DEPTH:
                    nodes.append(opened(value))
                path.append(value)
        else:
            if value in MAIN and main:
                main -= 1
            if value in path:
                closed(len(path) - 1 - path[::-1].index(value))
    flush()
    return root


# A wrapper is [{name: wrapper of its content}, chain], a chain a list of parts: [names, optional, repeated].
# A part of more than one name is repeated, and none of its names is needed each time. None fits any content.
Wrapper = list | None


def page_wrapper(children: list[tuple]) -> Wrapper:
    """The wrapper of one page (of ``tree``), or of an element's content."""
    contents: dict[str, Wrapper] = {}
    for c in children:
        if c[0] != TEXT:
            own = page_wrapper(c[1])
            contents[c[0]] = generalise(contents[c[0]], own) if c[0] in contents else own
    return [contents, _chain([[[c[0]], False, False] for c in children])]


def _joined(a: list, b: list, optional: bool, repeated: bool) -> list:
    names = a[0] if a[0] == b[0] else sorted({*a[0], *b[0]})
    return [names, optional, repeated or len(names) > 1]


def _chain(parts: list[list]) -> list[list]:
    """Parts side by side that share a name become one, and so do all from the first to the last
    of more than two that do."""
    after: dict[int, int] = {}  # the last part that a part becomes one with
    while True:
        out: list[list] = []
        last = -1
        for i, part in enumerate(parts):
            if out and (i <= last or not set(out[-1][0]).isdisjoint(part[0])):
                out[-1] = _joined(out[-1], part, out[-1][1] and part[1], True)
            else:
                out.append(part)
            last = max(last, after.get(i, -1))
        at: dict[str, list[int]] = {}
        for i, part in enumerate(out):
            for name in part[0]:
                at.setdefault(name, []).append(i)
        after = {}
        for held in at.values():
            if len(held) > 2:
                after[held[0]] = max(held[-1], after.get(held[0], 0))
        if len(out) == len(parts) and not after:
            return out
        parts = out


def generalise(a: Wrapper, b: Wrapper) -> Wrapper:
    """The wrapper of all that ``a`` or ``b`` fits: the chains are aligned by names, needed parts first."""
    if a == b:
        return a
    if a is None or b is None:
        return None
    contents = dict(a[0])
    for name, content in b[0].items():
        contents[name] = generalise(contents[name], content) if name in contents else content
    return [contents, _aligned(a[1], b[1])]


def _aligned(a: list[list], b: list[list]) -> list[list]:
    if a == b:
        return a
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]

    def worth(i: int, j: int) -> int:
        return 0 if set(a[i][0]).isdisjoint(b[j][0]) else 3 - a[i][1] - b[j][1]

    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            w = worth(i, j)
            best[i][j] = max(best[i + 1][j], best[i][j + 1], w and w + best[i + 1][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        w = worth(i, j)
        if w and best[i][j] == w + best[i + 1][j + 1]:
            out.append(_joined(a[i], b[j], a[i][1] or b[j][1], a[i][2] or b[j][2]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            out.append([a[i][0], True, a[i][2]])
            i += 1
        else:
            out.append([b[j][0], True, b[j][2]])
            j += 1
    return _chain(out + [[names, True, repeated] for names, _, repeated in a[i:] + b[j:]])


def _sizes(wrapper: Wrapper) -> list[int]:
    """Names by depth."""
    out, level = [], [wrapper]
    while level := [content for w in level if w for content in w[0].values()]:
        out.append(len(level))
    return out


def bounded(wrapper: Wrapper, most: int | None = None) -> Wrapper:
    """The wrapper cut at the depth where it has no more than ``most`` (NODES) nodes, its top at least."""
    def cut(w: Wrapper, depth: int) -> Wrapper:
        if w is None or depth < 0:
            return w if w and not w[1] else None
        return [{name: cut(content, depth - 1) for name, content in w[0].items()}, w[1]]

    held = list(accumulate(_sizes(wrapper)))
    if not held or held[-1] <= (most or NODES):
        return wrapper
    return cut(wrapper, max(1, sum(x <= (most or NODES) for x in held)) - 1)


def expression(wrapper: Wrapper) -> str:
    """``...`` stands for what was cut off, ``=`` for more than texts that an element of that name had before."""
    if wrapper is None:
        return "..."
    out, held = [], {TEXT: TEXT}
    for names, optional, repeated in wrapper[1]:
        each = []
        for name in names:
            if name not in held:
                content = wrapper[0][name]
                each.append(" ".join(x for x in (f"<{name}>", expression(content), f"</{name}>") if x))
                held[name] = f"<{name}> = </{name}>" if content and content[0] else each[-1]
            else:
                each.append(held[name])
        text = each[0] if len(each) == 1 else " ".join(f"({x})?" for x in each)
        text = f"({text})+" if repeated else text
        out.append(f"({text})?" if optional else text)
    return " ".join(out)


def generalised(wrappers: list[Wrapper]) -> Wrapper:
    out = wrappers[0] if wrappers else [{}, []]
    for w in wrappers[1:]:
        out = bounded(generalise(out, w))
    return out


def infer(pages: list[str]) -> str:
    """The wrapper of a host's pages, as one expression."""
    return expression(generalised([page_wrapper(tree(p)) for p in pages]))


def places(names: list[str], chain: list[list]) -> list[int]:
    """The part that each of an element's children belongs to: parts never go back, one that is not repeated
    takes one child, and the fewest needed parts are left out; leftmost on ties. -1 for all if no way fits."""
    where: dict[str, list[int]] = {}
    for i, part in enumerate(chain):
        for name in part[0]:
            where.setdefault(name, []).append(i)
    needed = list(accumulate((not part[1] for part in chain), initial=0))
    ways, steps = {-1: 0}, []  # needed parts left out up to each part a child may belong to
    for name in names:
        found, back = {}, {}
        for i in where.get(name, ()):
            for before, cost in ways.items():
                if before > i or (before == i and not chain[i][2]):
                    continue
                cost += needed[i] - needed[before + 1] if before < i else 0
                if i not in found or (cost, before) < (found[i], back[i]):
                    found[i], back[i] = cost, before
        if not found:
            return [-1] * len(names)
        ways = found
        steps.append(back)
    if not names:
        return []
    at = min(ways, key=lambda i: (ways[i] + needed[-1] - needed[i + 1], i))
    out = []
    for back in reversed(steps):
        out.append(at)
        at = back[at]
    return out[::-1]


def matched(children: list[tuple], wrapper: Wrapper, slot: str = "") -> list[tuple[str, str, bool]]:
    """(slot, text, inside article or main) of a page's texts, by the wrapper it is matched against.
    Below what it holds, texts belong to the deepest element it does hold."""
    out = []
    for child, i in zip(children, places([c[0] for c in children], wrapper[1]) if wrapper else [-1] * len(children)):
        at = f"{slot}/{i}{child[0]}" if i >= 0 else slot
        if child[0] == TEXT:
            out.append((at, child[1], child[2]))
        elif child[1]:
            out += matched(child[1], wrapper[0][child[0]] if i >= 0 else None, at)
    return out


def _digest(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def slot_text(slot: str, text: str) -> bytes:
    return _digest(f"{slot}\n{text}")


@lru_cache(maxsize=64)
def _read(wrapper: str | None) -> Wrapper:
    return json.loads(wrapper) if wrapper else None


def _text(wrapper: Wrapper) -> str:
    return json.dumps(wrapper, separators=(",", ":"), sort_keys=True)


def _page_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"host": b["host"], "wrapper": [_text(bounded(page_wrapper(tree(h)))) for h in b["html"]]}).drop_duplicates()


def _generalised(group: pd.DataFrame) -> pd.DataFrame:
    # Long ones first: a short one then meets the parts that the others all need.
    out = generalised([_read(w) for w in sorted(group["wrapper"], key=lambda w: (-len(w), w))])
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [_text(out)]})


def _by_host(pages: DataFrame) -> DataFrame:
    return pages.filter("html IS NOT NULL").select(host_of(F.col("url")).alias("host"), "html")


def host_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON): all different wrappers of a host's pages generalised, FAN or so at a time."""
    kind = "host string, wrapper string"
    left = written(_by_host(pages).mapInPandas(_page_wrappers, kind).distinct(), "page-wrappers")
    while True:
        several = written(left.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "hosts")
        if several.isEmpty():
            return left
        # Groups are dealt by what the wrappers say, so they are the same however pages are partitioned.
        dealt = left.join(several, "host").withColumn("part", F.expr(f"pmod(xxhash64(wrapper), ceil(n / {FAN}))"))
        merged = dealt.groupBy("host", "part").applyInPandas(_generalised, kind).distinct()
        left = written(merged.union(left.join(several, "host", "left_anti")), "host-wrappers")


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper as an expression."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"host": b["host"], "wrapper": [expression(_read(w)) for w in b["wrapper"]]})
    return host_wrappers(pages).mapInPandas(run, "host string, wrapper string")


def _slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"host": b["host"], "page": [_digest(h) for h in b["html"]], "slots": [
            sorted({slot_text(s, t) for s, t, main in matched(tree(h), _read(w)) if not main})
            for h, w in zip(b["html"], b["wrapper"])]})


def fixed_texts(pages: DataFrame, known: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """host, fixed: texts outside the article that all different pages of the host have in the same slot of
    their wrapper (``known``: host, wrapper), for hosts of ``least`` different pages or more."""
    once = written(_by_host(pages).join(known, "host").mapInPandas(
        _slots, "host string, page binary, slots array<binary>").dropDuplicates(["host", "page"]), "page-slots")
    held = once.select("host", F.explode("slots").alias("slot")).groupBy("host", "slot").agg(F.count(F.lit(1)).alias("c"))
    whole = once.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    # A host has no more fixed texts than its shortest page.
    return held.filter(F.col("c") >= least).join(whole, "host").filter("c = n").groupBy("host").agg(
        F.collect_list("slot").alias("fixed"))


def main_text(html: str | None, wrapper: Wrapper = None, fixed=()) -> str:
    texts = matched(tree(html), wrapper)
    inside = [t for _, t, main in texts if main]
    if inside:
        return " ".join(inside)
    known = set(fixed)
    return " ".join(t for s, t, _ in texts if not known or slot_text(s, t) not in known)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        text = [main_text(h, _read(w), () if f is None else f) for h, w, f in zip(b["html"], b["wrapper"], b["fixed"])]
        yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})


def extract(pages: DataFrame, per_host: int | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).
    All pages of a host count, so ``per_host`` (once the size of a sample) changes nothing."""
    pages = pages.select("page_id", "url", "html")
    known = host_wrappers(pages)
    known = written(known.join(fixed_texts(pages, known), "host", "left"), "fixed-texts")
    kind = pages.schema["page_id"].dataType.simpleString()
    # One row per host; a hot host's pages stream past it.
    joined = pages.withColumn("host", host_of(F.col("url"))).join(known, "host", "left")
    return joined.select("page_id", "url", "html", "wrapper", "fixed").mapInPandas(
        _extract, f"page_id {kind}, url string, text string, n_chars long")
