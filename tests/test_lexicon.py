"""Lexicon scorer against a plain-Python scorer of the same rules (brute force
over the small fixture), plus edge rows."""

import math
import re
import string
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tonality.operators.lexicon import document_scores, lexicon_tables, sentence_scores, word_roles
from tonality.plans.checks import FIXTURE_BOOSTERS, FIXTURE_LEXICON, FIXTURE_NEGATORS

from paths import SF_SMALL

LEX = dict(FIXTURE_LEXICON)
BOO = dict(FIXTURE_BOOSTERS)
NEG = set(FIXTURE_NEGATORS)


def rnd(x, n):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))


def isupper(w):
    return w.upper() == w and w.lower() != w


def py_sentences(text):
    text = re.sub(r"^\s+|\s+$", "", text, flags=re.ASCII)
    return [s for s in re.sub(r"([.!?]+)\s+", "\\1\x01", text, flags=re.ASCII).split("\x01") if s]


def py_words(sentence):
    out = []
    for w in [x for x in re.split(r"\s+", sentence, flags=re.ASCII) if x]:
        st = w.strip(string.punctuation)
        out.append(w if len(st) <= 2 else st)
    return out


def py_score(sentence):
    words = py_words(sentence)
    lw = [w.lower() for w in words]
    n_caps = sum(isupper(w) for w in words)
    cap_diff = 0 < n_caps < len(words)
    vals = []
    for i, w in enumerate(lw):
        if w in BOO or w not in LEX:
            vals.append(0.0)
            continue
        v = LEX[w]
        if isupper(words[i]) and cap_diff:
            v += 0.733 if v > 0 else -0.733
        for k in range(3):
            j = i - k - 1
            if j < 0 or lw[j] in LEX:
                continue
            if lw[j] in BOO:
                s = -BOO[lw[j]] if v < 0 else BOO[lw[j]]
                if isupper(words[j]) and cap_diff:
                    s += 0.733 if v > 0 else -0.733
                v = v + s * (1.0, 0.95, 0.9)[k]
            if lw[j] in NEG or "n't" in lw[j]:
                v = v * -0.74
        vals.append(v)
    if "but" in lw:
        b = lw.index("but")
        vals = [v * 0.5 if i < b else v * 1.5 if i > b else v for i, v in enumerate(vals)]
    if not vals:
        return 0.0, 0.0, 0.0, 0.0
    punct = min(sentence.count("!"), 4) * 0.292
    q = sentence.count("?")
    punct += 0.0 if q <= 1 else (q * 0.18 if q <= 3 else 0.96)
    s = sum(vals)
    s = s + punct if s > 0 else s - punct if s < 0 else s
    compound = rnd(s / math.sqrt(s * s + 15.0), 4)
    ps = sum(v + 1 for v in vals if v > 0)
    ns = sum(v - 1 for v in vals if v < 0)
    neu = float(sum(1 for v in vals if v == 0))
    if ps > abs(ns):
        ps += punct
    elif ps < abs(ns):
        ns -= punct
    tot = ps + abs(ns) + neu
    return compound, rnd(abs(ps / tot), 3), rnd(abs(neu / tot), 3), rnd(abs(ns / tot), 3)


@pytest.fixture(scope="module")
def roles(spark):
    return word_roles(*lexicon_tables(spark, FIXTURE_LEXICON, FIXTURE_BOOSTERS, FIXTURE_NEGATORS))


def test_sentence_scores_match_python_rules(spark, roles):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {(r.doc_id, r.sid): (r.compound, r.pos, r.neu, r.neg)
           for r in sentence_scores(docs, roles).collect()}
    want = {}
    for r in docs.collect():
        if r.text is None:
            continue
        for sid, s in enumerate(py_sentences(r.text)):
            want[(r.doc_id, sid)] = py_score(s)
    assert set(got) == set(want)
    bad = [(k, got[k], want[k]) for k in want
           if any(abs(a - b) > 1e-9 for a, b in zip(got[k], want[k]))]
    assert not bad, bad[:5]
    assert sum(1 for v in want.values() if v[0] != 0) > 50


def test_rules_on_crafted_sentences(spark, roles):
    rows = [("a", "This works."), ("b", "It this works."), ("c", "is this"),
            ("d", "THIS is fine"), ("e", "this but that"), ("f", "this!!"),
            ("g", "on by"), ("h", "isn't that")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.compound for r in sentence_scores(df, roles).collect()}
    for k, text in rows:
        assert got[k] == py_score(text)[0], (k, text)
    assert got["b"] < 0 < got["a"]          # negator flips
    assert got["c"] > got["a"]              # booster before a positive word


def test_edge_rows_and_duplicate_ids(spark, roles):
    rows = [("e1", None), ("e2", ""), ("e5", "x. y! z?"), ("e6", "this was."),
            ("e6", "that."), ("e7", "   ")]
    df = spark.createDataFrame(rows, "review_id string, text string")
    got = {r.review_id: (r.vader, r.n) for r in
           document_scores(df, roles, id_col="review_id").collect()}
    assert "e1" not in got and "e2" not in got and "e7" not in got  # no sentence, no score
    assert got["e5"] == (0.0, 3)
    c1, c2 = py_score("this was.")[0], py_score("that.")[0]
    assert got["e6"][1] == 2
    assert abs(got["e6"][0] - (c1 + c2) / 2) < 1e-12


def test_exact_duplicate_rows_average_like_one(spark, roles):
    one = spark.createDataFrame([("d", "this is good. that was bad!")], "doc_id string, text string")
    two = one.unionByName(one)
    a = document_scores(one, roles).collect()[0]
    b = document_scores(two, roles).collect()[0]
    assert a.vader == b.vader and b.n == 2 * a.n


def test_small_tables_score_in_row_without_joins(spark, roles):
    df = spark.createDataFrame([("a", "this is it")], "doc_id string, text string")
    plan = document_scores(df, roles)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1   # only the per-id groupBy


def test_broadcast_join_path_equals_in_row_path(spark, roles):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    joined = document_scores(docs, roles, in_row=False)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert {tuple(r) for r in joined.collect()} == {tuple(r) for r in document_scores(docs, roles).collect()}
    a = {(r.doc_id, r.sid): tuple(r)[-4:] for r in sentence_scores(docs, roles, in_row=False).collect()}
    b = {(r.doc_id, r.sid): tuple(r)[-4:] for r in sentence_scores(docs, roles).collect()}
    assert a == b


def test_salted_path_equals_broadcast_path(spark, roles):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    a = {tuple(r) for r in document_scores(docs, roles).collect()}
    b = {tuple(r) for r in document_scores(docs, roles, max_broadcast_rows=1).collect()}
    assert a == b


def test_left_score_join_fills_missing(spark, roles):
    from tonality.operators.joins import join_scores
    reviews = spark.createDataFrame([("a", "this."), ("b", None)], "review_id string, text string")
    scores = document_scores(reviews, roles, id_col="review_id").select("review_id", "vader")
    inner = {r.review_id for r in join_scores(reviews, scores).collect()}
    left = {r.review_id: r.vader for r in
            join_scores(reviews, scores, how="left", fill={"vader": 0.0}).collect()}
    assert inner == {"a"} and left["b"] == 0.0 and left["a"] > 0


def test_many_distinct_values_fall_back_to_join_path(spark):
    from tonality.operators.lexicon import MAX_VALUE_GROUPS
    words = [(f"w{i}", 0.001 * (i + 1)) for i in range(MAX_VALUE_GROUPS + 5)] + [("this", 1.9)]
    big = word_roles(*lexicon_tables(spark, words, FIXTURE_BOOSTERS, FIXTURE_NEGATORS))
    df = spark.createDataFrame([("a", "w3 this is fine. It w300 here"), ("b", "nothing")],
                               "doc_id string, text string")
    scores = document_scores(df, big)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan                     # too many values for in-row sets
    assert {tuple(r) for r in scores.collect()} == \
        {tuple(r) for r in document_scores(df, big, in_row=False).collect()}
