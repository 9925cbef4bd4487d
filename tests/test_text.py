from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from tonality.fixed import NLTK_ENGLISH_STOP_WORDS
from tonality.functions.text import (default_stop_words, remove_stop_words, split_sentences,
                                     strip_punctuation, tokenize)

from paths import SF_SMALL

EDGE = ["", "a  b. B\tC ", "   ", "good", "x. y! z?", "Hello WORLD", " lead", "tab\tend\t"]


def _twin(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    ml = Tokenizer(inputCol="text", outputCol="ml").transform(df)
    return {r.id: (r.ml, r.native) for r in ml.withColumn("native", tokenize(F.col("text"))).collect()}


def test_tokenize_equals_mllib_on_edges(spark):
    for i, (ml, native) in _twin(spark, EDGE).items():
        assert ml == native, (EDGE[i], ml, native)


def test_tokenize_edge_shapes(spark):
    got = _twin(spark, EDGE)
    assert got[0][1] == [""]                      # empty text: one empty token
    assert got[1][1] == ["a", "", "b.", "b", "c"]  # inner empty token kept, trailing dropped
    assert got[2][1] == []                        # whitespace only: no token
    assert got[6][1] == ["", "lead"]


def test_tokenize_and_stop_words_equal_mllib_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    ml = Tokenizer(inputCol="text", outputCol="words").transform(docs)
    ml = StopWordsRemover(inputCol="words", outputCol="ml_default").transform(ml)
    ml = StopWordsRemover(inputCol="words", outputCol="ml_nltk",
                          stopWords=list(NLTK_ENGLISH_STOP_WORDS)).transform(ml)
    native = ml.select(
        "words", "ml_default", "ml_nltk",
        tokenize(F.col("text")).alias("t"),
        remove_stop_words(tokenize(F.col("text")), default_stop_words()).alias("d"),
        remove_stop_words(tokenize(F.col("text")), NLTK_ENGLISH_STOP_WORDS).alias("n"))
    rows = native.collect()
    assert len(rows) == 200
    for r in rows:
        assert r.words == r.t
        assert r.ml_default == r.d
        assert r.ml_nltk == r.n


def test_default_stop_words_are_sparks(spark):
    assert list(default_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(NLTK_ENGLISH_STOP_WORDS) == 179


def test_stop_word_filter_is_hashed_set(spark):
    df = spark.createDataFrame([(["the", "cat"],)], "t array<string>")
    plan = df.select(remove_stop_words(F.col("t"), NLTK_ENGLISH_STOP_WORDS).alias("k")) \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan.upper()


def test_sentences_and_strip(spark):
    df = spark.createDataFrame([("  Dr. Smith came!  Did he? Yes...  ",), ("",), (None,), ("no end",)],
                               "text string")
    got = [r.s for r in df.select(split_sentences(F.col("text")).alias("s")).collect()]
    assert got == [["Dr.", "Smith came!", "Did he?", "Yes..."], [], None, ["no end"]]
    w = spark.createDataFrame([("(good)",), (":)",), ("a.",), ("'tis",)], "w string")
    got = [r.x for r in w.select(strip_punctuation(F.col("w")).alias("x")).collect()]
    assert got == ["good", ":)", "a.", "tis"]


def test_long_runs_and_control_characters(spark):
    n = 300_000
    rows = [("a" + " " * n + "b.",), ("." * n + "x y",), ("one\u0001two. three",), (" " * n,)]
    df = spark.createDataFrame(rows, "text string")
    got = [(r.s, r.t) for r in df.select(split_sentences(F.col("text")).alias("s"),
                                         tokenize(F.col("text")).alias("t")).collect()]
    assert got[0][0] == [rows[0][0]] and len(got[0][1]) == n + 1
    assert got[1] == ([rows[1][0]], ["." * n + "x", "y"])
    assert got[2][0] == ["one\u0001two.", "three"]
    assert got[3] == ([], [])
