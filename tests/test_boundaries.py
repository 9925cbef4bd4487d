"""Learnt sentence boundaries: what is learnt from plain texts, and how it is applied."""

import math
import random

import pytest

from tonality.operators.boundaries import (abbreviation_score, learn_boundaries, learned_sentences, pair_score,
                                           segments)
from tonality.operators.lexicon import document_scores, lexicon_tables, word_roles
from pyspark.sql import functions as F


def corpus():
    rng = random.Random(11)
    nouns = [f"noun{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    texts = []
    for _ in range(400):
        parts = []
        for _ in range(6):
            parts.append(f"{rng.choice(['The', 'However', 'It'])} {' '.join(rng.choices(nouns, k=6))} met "
                         f"{rng.choice(['Dr. Smith', 'Mr. Jones', 'Dr. Brown', 'the U.S. army', 'p. 12'])} "
                         f"{' '.join(rng.choices(nouns, k=3))}.")
        texts.append(" ".join(parts))
    return texts


@pytest.fixture(scope="module")
def model(spark):
    return learn_boundaries(spark.createDataFrame([(t,) for t in corpus()], "text string").repartition(4))


def test_abbreviations_and_starters_are_learnt(model):
    assert {r.typ for r in model.abbreviations.collect()} == {"dr", "mr", "u.s", "p"}
    starters = {r.typ for r in model.starters.collect()}
    assert {"however", "it"} <= starters and not any(s.startswith("noun") for s in starters)


TEXTS = [
    ("I saw Dr. Smith today. He left.", ["I saw Dr. Smith today.", "He left."]),
    ("We met Mr.  Jones and\nDr. Brown!  Why? See p. 12.", ["We met Mr.  Jones and\nDr. Brown!", "Why?", "See p. 12."]),
    ("He lives in the U.S. However it rains. (He left the U.S. army.)",
     ["He lives in the U.S.", "However it rains.", "(He left the U.S. army.)"]),
    ("Odd \x01\x03 and \x01. marks \x01\x02. Dr. \x01 X.", ["Odd \x01\x03 and \x01.", "marks \x01\x02.", "Dr. \x01 X."]),
    ("  \n ", []), ("", []), (None, []), ("no mark at all", ["no mark at all"]), ("Wait... what?! yes.", ["Wait...", "what?!", "yes."]),
]


@pytest.mark.parametrize("max_inline", [100_000, 0])
def test_sentences(spark, model, max_inline):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)] + [(None, TEXTS[0][0]), (0, TEXTS[0][0])],
                               "doc_id int, text string")
    got = {}
    for r in learned_sentences(df, model, max_inline=max_inline).orderBy("doc_id", "sid").collect():
        got.setdefault(r.doc_id, []).append(r.sentence)
    assert got.pop(None) == TEXTS[0][1]
    assert got.pop(0) == sorted(TEXTS[0][1] * 2, key=TEXTS[0][1].index)
    assert got == {i: s for i, (_, s) in enumerate(TEXTS) if s and i}


def test_segments_give_the_text_back(spark):
    for t, _ in TEXTS:
        if t is not None:
            s = spark.createDataFrame([(t,)], "t string").select(segments(F.col("t")).alias("s")).first().s
            assert "".join(s) == t.strip()


def test_scores_equal_the_formulas(spark):
    def ll(k, n, p):
        return k * math.log(p) + (n - k) * math.log(1 - p)

    row = spark.range(1).select(
        abbreviation_score(F.lit(7.0), F.lit(1.0), F.lit("u.s"), 500.0, 9000.0).alias("a"),
        pair_score(F.lit(40.0), F.lit(30.0), F.lit(12.0), F.lit(9000.0)).alias("p"),
        pair_score(F.lit(12.0), F.lit(12.0), F.lit(12.0), F.lit(9000.0)).alias("q")).first()
    want = -2 * (ll(7, 8, 500 / 9000) - ll(7, 8, 0.99)) * math.exp(-2) * 2 * 2 ** -1
    assert math.isclose(row.a, want)
    p, p1, p2 = 30 / 9000, 12 / 40, 18 / 8960
    assert math.isclose(row.p, -2 * (ll(12, 40, p) + ll(18, 8960, p) - ll(12, 40, p1) - ll(18, 8960, p2)))
    p = 12 / 9000
    assert math.isclose(row.q, -2 * (ll(12, 12, p) + ll(0, 8988, p)))


def test_empty_and_unlucky_corpora(spark):
    for texts in ([], [None], [""], ["one two"], ["all. with. marks."], ["..."]):
        df = spark.createDataFrame([(1, t) for t in texts], "doc_id int, text string")
        m = learn_boundaries(df)
        assert learned_sentences(df, m).count() == {"all. with. marks.": 3}.get(texts[0] if texts else "", int(bool(texts and texts[0])))


def test_long_texts_take_linear_time(spark, model):
    df = spark.createDataFrame([(1, "Dr. X met him. " * 60_000), (2, "a" * 500_000 + "." * 500_000)], "doc_id int, text string")
    assert {r.doc_id: r["count"] for r in learned_sentences(df, model).groupBy("doc_id").count().collect()} == {1: 60_000, 2: 1}


def test_lexicon_scores_take_learnt_boundaries(spark, model):
    roles = word_roles(*lexicon_tables(spark, [("good", 2.0)]))
    df = spark.createDataFrame([(1, "Dr. Smith is good. Yes.")], "doc_id int, text string")
    assert document_scores(df, roles).first().n == 3
    assert document_scores(df, roles, boundaries=model).first().n == 2
