"""URL filters with redirect equivalence.

A rule (host, path prefix, verdict) fits its host and all subdomains; the
longest fitting rule decides a url. All canonical links and refresh redirects found
in the pages are edges between urls; their character references are decoded and
relative ones resolved against the page's ``base`` or its url; a url without a rule takes the decision of
its connected component: allow if any alias is explicitly allowed, else block if
any alias is explicitly blocked, else allow.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and verdict allow; null html gives no edge; repeated rows are judged
alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import lower_ascii, written
from tonality.llm.components import connected_components
from tonality.llm.tags import tags

# (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
REFRESH_URL = re.compile(r"""\s*[\d.]*\s*[;,]?\s*url\s*=\s*(?:"([^"]*)"?|'([^']*)'?|(.*))""", re.I | re.S)


def rest_of(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(rest_of(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def _node(url: Column) -> Column:
    """One text per address: scheme, fragment, a scheme's usual port and an empty path do not count."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    port = F.when(url.rlike(r"(?i)^https:"), F.regexp_replace(host_of(url), ":443$", "")).otherwise(
        F.regexp_replace(host_of(url), ":80$", ""))
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    return F.when(host_of(url) != "", F.concat(port, path, query))


def _value(found: str) -> str:
    """The text of an attribute's value as it stands in the page."""
    if found[:1] in ("'", '"') and found[-1:] == found[:1]:
        found = found[1:-1]
    return entities.unescape(found).strip()


def target(url: str, base: str, found: str, refresh: bool) -> str | None:
    """The absolute url a link or redirect of the page ``url`` leads to, if there is one."""
    to = _value(found)
    if refresh:
        m = REFRESH_URL.match(to)
        to = (m[1] or m[2] or m[3] or "").strip() if m else ""
    if not to:
        return None
    try:
        to = urljoin(urljoin(url, _value(base)) if base else url, to)
    except ValueError:  # not a url, such as http://[x
        return None
    return to if "://" in to else None


def references(html: str) -> Iterator[tuple[str, str, bool]]:
    """(base, value, refresh) of every canonical link and refresh redirect among the page's tags;
    what stands in comments and scripts is none."""
    base, found = "", []
    for tag in tags(html):
        if tag.closing or tag.name not in ("link", "meta", "base"):
            continue
        held: dict[str, str] = {}
        for name, value in ATTRIBUTE.findall(tag.attributes):
            held.setdefault(name.lower(), value)
        if tag.name == "base":
            base = base or held.get("href", "")
        elif tag.name == "link" and held.get("href") and "canonical" in _value(held.get("rel", "")).lower().split():
            found.append((held["href"], False))
        elif tag.name == "meta" and held.get("content") and _value(held.get("http-equiv", "")).lower() == "refresh":
            found.append((held["content"], True))
    for value, refresh in found:
        yield base, value, refresh


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = [(url, target(url, *found)) for url, html in zip(b["url"], b["html"]) for found in references(html)]
        yield pd.DataFrame(out, columns=["u", "v"])


def alias_edges(pages: DataFrame) -> DataFrame:
    """(u, v) urls joined by a canonical link or a refresh redirect."""
    marked = pages.filter(F.col("html").rlike(r"(?i)canonical|http-equiv") & F.col("url").isNotNull())
    return marked.select("url", "html").mapInPandas(_edges, "u string, v string").filter("v IS NOT NULL")


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url, html)."""
    url = F.col("url")
    judged = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_node", _node(url))
    edges = written(alias_edges(pages).select(
        _node(F.col("u")).alias("u"), _node(F.col("v")).alias("v")).filter("u <> v").distinct(), "alias-edges")
    if edges.isEmpty():
        verdict = F.coalesce(F.col("_r.verdict"), F.lit("allow"))
        return judged.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"))
    comp = written(connected_components(edges), "alias-components")
    # Targets that are not pages themselves carry a rule's decision as well.
    as_url = F.concat(F.lit("x://"), F.col("node"))
    ruled = comp.withColumn("_v", rule_of(host_of(as_url), path_of(as_url), rules)["verdict"])
    decided = ruled.groupBy("component").agg(
        F.min("_v").alias("_component_verdict"))  # 'allow' sorts before 'block'
    per_node = comp.join(decided, "component").select(F.col("node").alias("_node"), "_component_verdict")
    out = judged.join(per_node, "_node", "left")
    verdict = F.coalesce(F.col("_r.verdict"), F.col("_component_verdict"), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"))
