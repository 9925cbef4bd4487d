"""Personal data: candidate generators, gradient-boosted trees, calibrated thresholds.

High-recall patterns propose overlapping spans. Base kinds (email, ip, card, phone) are
decided by their formats. Further spans of kind ``number`` (digit groups), ``handle``
(@name) and ``secret`` (mixed letters and digits, or a value after ``password=``, ``token = "`` and
the like) are selected by boosted trees over yes/no features of a candidate and the text before it.
The features take 2 ** len(FEATURES) values at most, so the trees are fitted
exactly, on counts per feature value over all candidates; labels come from
the base rules (a candidate that overlaps a base span is personal), from cues (a secret assigned
to its cue, a secret or handle right after one) and from the candidate's own form (a handle
with a digit or underscore, a secret whose characters look drawn at random). Each kind's threshold is the least score from which the precision on those counts is at
least ``PRECISION``. Everything is DataFrame functions; there is no Python UDF.

Defined results: null or empty texts have no spans (hash of the empty string);
repeated rows are judged alike; with no candidate nothing is selected; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("handle", "number", "secret")
PRECISION = 0.9
ROUNDS = 12
RATE = 0.5
SECRET_NAME = r"(?i:password|passwd|pwd|token|secret|key|apikey|api_key)"
ASSIGNED = r"[\"']?[\x20\t]{0,8}+[=:]>?[\x20\t]{0,8}+"
# Possessive forms find the same spans without backtracking over long runs; a run that
# was tried from its start is not tried again from its middle.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "handle": r"(?<![A-Za-z0-9._%+@-])@[A-Za-z0-9_]{3,30}+",
    "number": r"[0-9]{2,}+(?:[\x20.-][0-9]{2,}+)*+",
    "secret": rf"(?<![A-Za-z0-9_=-])(?:{SECRET_NAME}{ASSIGNED}(?:\"[^\"\r\n]{{4,256}}+\"|'[^'\r\n]{{4,256}}+'|[^\s,;]{{4,}}+)"
              r"|(?=[A-Za-z_-]{0,40}[0-9])(?=[0-9_-]{0,40}[A-Za-z])[A-Za-z0-9_-]{16,}+)",
}
CUE = r"(?i)(call|phone|tel|mail|contact|card|account|ssn|iban|id|no|number|password|passwd|pwd|token|secret|key)[\s.:=#\"']*$"
# A value after "name: " may be prose; without space, sign = or quotes it needs a digit, except a password.
SECRET_CUE = (rf"^{SECRET_NAME}(?:[=:]\S|[\"']?[\x20\t]*+(?:=|:[\x20\t]*+(?:[\"']|\S*[0-9])))"
              r"|^(?i:password|passwd|pwd|apikey|api_key)[\"']?[\x20\t]*+[=:]")
NAMED = {"secret": rf"(?<![A-Za-z0-9]){SECRET_NAME}[\s.:=#\"'`(\[]*$",
         "handle": r"(?<![A-Za-z0-9])(?i:mail|contact|account|user|username|handle|nick|follow|message|dm|twitter|instagram"
                   r"|telegram|mastodon|github)[\s.:=#\"'(]*$"}
# Bits per character, and changes between letters and digits, of strings drawn at random.
ENTROPY, CHANGES = 3.0, 4
FEATURES = ("cue", "long", "longer", "separated", "digits_only", "equals", "plus_before", "at_nearby", "named", "formed")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def passes(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), F.call_function("luhn_check", _digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "number":
        return n >= 7
    return F.lit(True)


def spans_of(kind: str, text: Column) -> Column:
    """array<struct<s, e, value>> of the matches that pass, in order; s and e count
    code points. Matches alternate with the pieces between them, so a running
    length gives positions."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<struct<s:int,e:int,value:string>>").alias("got"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.length(x["value"])
        got = F.when(passes(kind, x["value"]), F.concat(F.coalesce(acc["got"], F.array().cast(
            "array<struct<s:int,e:int,value:string>>")), F.array(F.struct(
                s.alias("s"), e.alias("e"), x["value"].alias("value"))))).otherwise(acc["got"])
        return F.struct(e.alias("at"), got.alias("got"))

    zipped = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)),
                        lambda v, g: F.struct(g.alias("gap"), v.alias("value")))
    none = F.array().cast("array<struct<s:int,e:int,value:string>>")
    return F.when(F.size(found) == 0, none).otherwise(
        F.coalesce(F.aggregate(zipped, start, step, lambda acc: acc["got"]), none))


def entropy(value: Column) -> Column:
    """Shannon entropy of the characters of ``value``, in bits."""
    n = F.length(value).cast("double")

    def add(total: Column, c: Column) -> Column:
        share = (n - F.length(F.replace(value, c, F.lit("")))) / n
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(F.regexp_extract_all(value, F.lit(r"(?s)."), F.lit(0))), F.lit(0.0), add)


def formed(kind: str, value: Column) -> Column:
    """Whether the candidate's own form tells its kind, whatever stands around it."""
    if kind == "handle":
        return value.rlike(r"[A-Za-z]") & value.rlike(r"[0-9_]")
    if kind == "secret":
        changes = F.regexp_count(value, F.lit(r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"))
        # The cheap test comes first.
        return F.when(changes >= CHANGES, entropy(value) >= ENTROPY).otherwise(F.lit(False))
    return F.lit(False)


def _features(kind: str, text: Column, s: Column, e: Column, value: Column) -> dict[str, Column]:
    # 24 characters on either side are the candidate's context.
    before = F.substring(text, F.greatest(F.lit(1), s - 23), F.least(s, F.lit(24)))
    after = F.substring(text, e + 1, F.lit(24))
    return {
        "cue": before.rlike(CUE), "long": F.length(value) >= 10, "longer": F.length(value) >= 16,
        "separated": value.rlike(r"[\x20.()-]"), "digits_only": value.rlike(r"^[0-9]+$"),
        "equals": value.rlike(SECRET_CUE), "plus_before": before.rlike(r"\+[0-9\x20()-]*$"),
        "at_nearby": F.concat(before, after).rlike(r"@"),
        "named": before.rlike(NAMED[kind]) if kind in NAMED else F.lit(False), "formed": formed(kind, value),
    }


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` and ``_more``: arrays of struct(kind number, s, e, code,
    personal). ``code`` packs the yes/no features, ``personal`` is the weak label."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Texts without a digit or @ hold no base span; a cheap test spares them all patterns.
    some = text.rlike(rf"[0-9@]|{SECRET_NAME}{ASSIGNED}\S")
    kind_of = lambda k: F.lit(KINDS.index(k))
    empty = "array<struct<k:int,s:int,e:int>>"
    plain = lambda k: lambda x: F.struct(kind_of(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"))
    base = F.concat(*[F.transform(spans_of(k, text), plain(k)) for k in BASE])
    docs = docs.withColumn("_base", F.when(some, base).otherwise(F.array().cast(empty)))

    def candidate(k: str):
        def make(x: Column) -> Column:
            f = _features(k, text, x["s"], x["e"], x["value"])
            code = sum((F.when(f[n], F.lit(1 << i)).otherwise(F.lit(0)) for i, n in enumerate(FEATURES)), F.lit(0))
            inside = F.exists("_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
            personal = inside | f["equals"] | f["named"] | f["formed"]
            return F.struct(kind_of(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"),
                            code.alias("code"), personal.alias("personal"))
        return make

    more = F.concat(*[F.transform(spans_of(k, text), candidate(k)) for k in KINDS[len(BASE):]])
    return docs.withColumn("_more", F.when(some, more).otherwise(
        F.array().cast("array<struct<k:int,s:int,e:int,code:int,personal:boolean>>")))


def boost(counts: list[tuple[int, int, int]], rounds: int = ROUNDS, rate: float = RATE) -> dict[int, float]:
    """code -> score of two-level trees boosted on (code, personal, other) counts.
    At most 2 ** len(FEATURES) rows, so every split is exact."""
    if not counts:
        return {}
    n = len(FEATURES)
    score = {c: 0.0 for c, _, _ in counts}

    def leaf(rows) -> tuple[float, float]:
        g = sum(p - (p + o) / (1 + math.exp(-score[c])) for c, p, o in rows)
        h = sum((p + o) * (q := 1 / (1 + math.exp(-score[c]))) * (1 - q) for c, p, o in rows) + 1.0
        return g / h, g * g / h

    def split(rows):
        parts = [([r for r in rows if not r[0] >> i & 1], [r for r in rows if r[0] >> i & 1]) for i in range(n)]
        return max(parts, key=lambda ab: sum(leaf(x)[1] for x in ab if x))

    for _ in range(rounds):
        leaves = [part for half in split(counts) if half for part in split(half) if part]
        values = [leaf(rows)[0] for rows in leaves]
        for rows, value in zip(leaves, values):
            for c, _, _ in rows:
                score[c] += rate * value
    return {c: 1 / (1 + math.exp(-s)) for c, s in score.items()}


def calibrate(counts: list[tuple[int, int, int]], score: dict[int, float], precision: float) -> float:
    """The least score from which personal / all reaches ``precision`` (above 1: none)."""
    best, personal, other = 2.0, 0, 0
    for c, p, o in sorted(counts, key=lambda r: -score[r[0]]):
        personal, other = personal + p, other + o
        if personal >= precision * (personal + other):
            best = score[c]
    return best


def fit(docs: DataFrame, precision: float = PRECISION) -> dict[int, list[int]]:
    """kind number -> the feature codes whose score passes the kind's threshold."""
    rows = with_candidates(docs.select("text")).select(F.explode("_more").alias("c"))
    counts = rows.groupBy("c.k", "c.code").agg(
        F.sum(F.col("c.personal").cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).collect()
    chosen = {}
    for kind in range(len(BASE), len(KINDS)):
        mine = sorted((r.code, r.p, r.n - r.p) for r in counts if r.k == kind)
        score = boost(mine)
        limit = calibrate(mine, score, precision)
        chosen[kind] = [c for c in score if score[c] >= limit]
    return chosen


def with_spans(docs: DataFrame, chosen: dict[int, list[int]]) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans`` (base and selected ones), both by kind, then start."""
    out = with_candidates(docs)

    def selected(x: Column) -> Column:
        keep = F.lit(False)
        for k, codes in chosen.items():
            if codes:
                keep = keep | ((x["k"] == k) & x["code"].isin(codes))
        return keep

    plain = F.transform(F.filter("_more", selected), lambda x: F.struct(
        x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))
    return out.withColumn("_spans", F.array_sort(F.concat("_base", plain))).drop("_more")


def _told(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row."""
    out = with_spans(docs.select("doc_id", "text"), fit(docs))
    of_kind = lambda i: F.filter("_base", lambda x: x["k"] == i)
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return out.select("doc_id", *counts, F.sha2(_told(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
                      _told(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``[kind]``; overlapping spans become one,
    named after the first. All columns keep their names and order."""
    out = with_spans(docs, fit(docs))
    by_start = F.array_sort(F.transform("_spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.element_at(names, x["k"] + 1))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"),
                        F.when(x["s"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(by_start, start, step)
    clean = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    out = out.withColumn("text", F.when(F.size("_spans") > 0, clean).otherwise(text))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
