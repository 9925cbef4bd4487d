"""Multi-word units and their roles, against a plain scanner and hand-worked sentences."""

import random

import pytest
from pyspark.sql import functions as F

from tonality.fixed import PUBLISHED_PHRASES
from tonality.operators.lexicon import document_scores, lexicon_tables, sentence_scores, word_roles
from tonality.operators.phrases import merge_by_join, merge_in_row

PHRASES = ["a b", "b c d", "a b c d", "c d", "d d", "a a a", "b a", "d a b c"]


def scan(words, phrases):
    out, i = [], 0
    while i < len(words):
        n = max((p.count(" ") + 1 for p in phrases if words[i:i + p.count(" ") + 1] == p.split(" ")), default=1)
        out.append(" ".join(words[i:i + n]))
        i += n
    return out


@pytest.fixture(scope="module")
def sentences(spark):
    rng = random.Random(3)
    rows = [(i, 0, [rng.choice("abcdx") for _ in range(rng.randrange(0, 30))]) for i in range(300)]
    rows += [(None, 1, ["a", "b", "c"]), (7, 2, None), (8, 2, []), (9, 2, ["a", "b"] * 20_000), (7, 0, ["a", "b"]), (7, 0, ["a", "b"])]
    return spark.createDataFrame(rows, "doc_id long, sid int, words array<string>").withColumn("h", F.xxhash64("words"))


def test_longest_phrases_merge_like_a_scanner(spark, sentences):
    want = sorted((str(r.doc_id), r.sid, r.words if r.words is None else scan(r.words, PHRASES)) for r in sentences.collect())
    in_row = merge_in_row(sentences, PHRASES)
    table = spark.createDataFrame([(p,) for p in PHRASES], "w string")
    joined = merge_by_join(sentences, table, ["doc_id", "sid", "h"])
    for df in (in_row, joined):
        assert df.columns == sentences.columns
        assert sorted((str(r.doc_id), r.sid, r.words) for r in df.collect()) == want
    assert "Join" not in in_row._jdf.queryExecution().executedPlan().toString()


def test_words_keep_their_case_and_odd_characters(spark):
    df = spark.createDataFrame([(["Kind", "OF", "$1\\", "\x01", "of", "é"],)], "words array<string>")
    got = merge_in_row(df, ["kind of", "$1\\ \x01", "of é"]).first().words
    assert got == ["Kind OF", "$1\\ \x01", "of é"]


@pytest.fixture(scope="module")
def scores(spark):
    lexicon = [("good", 2.0), ("death", -2.0), ("bad", -2.5), ("kind", 2.4)]
    tables = lexicon_tables(spark, lexicon, [("very", 0.293)], ["never", "without", "not"], PUBLISHED_PHRASES)

    def run(texts, phrases=True, **kw):
        roles = word_roles(*(tables if phrases else tables[:3]))
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
        return {r.doc_id: r.compound for r in sentence_scores(df, roles, **kw).collect()}
    return run


def compound(s):
    return round(s / (s * s + 15) ** 0.5, 4)


CASES = [("It was the kiss of death", -1.5), ("kind of good", 2.0 - 0.293), ("a kind man", 2.4), ("never so good", 2.0 * 1.5),
         ("never so very good", (2.0 + 0.293) * 1.25), ("never good", 2.0 * -0.74), ("without doubt good", 2.0),
         ("without it good", 2.0 * -0.74), ("at least good", 2.0), ("least good", 2.0 * -0.74), ("least x good", 2.0),
         ("bad ass", 1.5), ("bad", -2.5), ("yeah right", -2.0), ("", None), (None, None), ("Kiss of  death, good", -1.5 + 2.0)]


def test_published_phrases(scores):
    got = scores([t for t, _ in CASES])
    for i, (text, s) in enumerate(CASES):
        assert got.get(i) == (None if s is None else compound(s)), text
    assert got == scores([t for t, _ in CASES], in_row=False)
    assert scores(["kiss of death"], phrases=False) == {0: compound(-2.0)}


def test_large_phrase_tables_join(spark, scores, monkeypatch):
    from tonality.operators import lexicon
    texts = [t for t, _ in CASES]
    want = scores(texts)
    monkeypatch.setattr(lexicon, "MAX_INLINE_WORDS", 3)
    assert scores(texts) == want


def test_both_paths_keep_repeated_rows(spark):
    roles = word_roles(*lexicon_tables(spark, [("good", 2.0)]))
    df = spark.createDataFrame([(1, "good. bad")] * 3 + [(2, "good")], "doc_id int, text string")
    a, b = (sorted(tuple(r) for r in sentence_scores(df, roles, in_row=x).collect()) for x in (True, False))
    assert a == b and len(a) == 7
    assert {r.doc_id: r.n for r in document_scores(df, roles, in_row=False).collect()} == {1: 6, 2: 1}


def test_over_long_phrases_raise(spark):
    tables = lexicon_tables(spark, [("one two three four five", 1.0)])
    with pytest.raises(Exception, match="more than 4 words"):
        word_roles(*tables).collect()
