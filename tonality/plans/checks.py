"""Registered checks: one Spark query per operator, over the driver's tables.

Every query reads ``documents`` / ``labels`` / ``conversations`` (or data
Spark derives from them) in full. Review-shaped queries use the stand-in
review table (``standin_reviews``). The lexicon checks score with the small
word tables of ``FIXTURES.md``; the metric checks evaluate the lexicon's own
three-class / binary verdicts against the labels, which is deterministic and
SQL-expressible. Model checks (logistic regression) are property checks.
"""

from __future__ import annotations

import time

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.fixed import NLTK_ENGLISH_STOP_WORDS
from tonality.functions.arrays import explode_values, explode_with_position
from tonality.functions.labels import binary, label, three_class
from tonality.functions.text import (default_stop_words, remove_stop_words,
                                     split_sentences, tokenize)
from tonality.operators.boundaries import learn_boundaries, learned_sentences
from tonality.operators.features import (document_frequency, hashed_term_frequency,
                                         inverse_document_frequency, term_frequency,
                                         tfidf, vector_total)
from tonality.operators.joins import join_scores
from tonality.operators.lexicon import (document_scores, lexicon_tables, polarity_class,
                                        sentence_scores, word_roles)
from tonality.operators.metrics import (binary_counts, confusion_matrix, micro_metrics,
                                        weighted_metrics)
from tonality.operators.resampling import paired_interval
from tonality.operators.split import exact_part, random_split, split_by_key, split_part
from tonality.plans.classifier import (ablation, ablation_interval, build_classifier, fit, predict, run_report,
                                       train_and_predict, trainable)
from tonality.session import scratch_path, table, text_table
from tonality.sources.models import load_model, save_model
from tonality.sources.review_files import drop_first_lines, drop_header, unquote, write_review_csv
from tonality.sources.reviews import (project_reviews, read_reviews_json, standin_reviews,
                                      write_reviews_json)
from tonality.sources.scores import read_score_lines, read_scores, write_scores
from tonality.streaming.batch_sink import folder_writer, start_batches
from tonality.streaming.score_stream import (read_review_stream, score_new_files, score_stream,
                                             with_review_key)

# Word tables of FIXTURES.md section 3: frequent words of the English test
# documents with arbitrary valence (no common sentiment word occurs there).
FIXTURE_LEXICON = (("this", 1.9), ("that", -1.5), ("from", 2.3), ("with", 0.8),
                   ("by", -2.1), ("was", -0.6))
FIXTURE_BOOSTERS = (("is", 0.293), ("on", -0.293))
FIXTURE_NEGATORS = ("it", "be")
# Phrases of 2 to 4 words that overlap there, one for each role (schemas.PHRASES).
FIXTURE_PHRASES = (("of the", 1.2, None, False, None, False), ("the and attion to", -1.8, None, False, None, False),
                   ("attion to", 0.9, None, False, None, False), ("the the the", None, None, False, None, False),
                   ("the the", 0.7, None, False, None, False), ("and the", None, None, True, None, False),
                   ("in the", None, None, False, 1.5, False), ("the anea", -0.9, None, False, None, False),
                   ("of of", None, 0.293, False, None, False), ("the of", None, None, False, None, True),
                   ("and", None, None, False, None, True))
HEADER = "review"
ASSEMBLED_NUM_FEATURES = 4096   # dense view of the assembled vector stays small
HASHED_CHECK_FEATURES = 1024    # per-document totals do not depend on bucket count
METRIC_DIGITS = 12
LONG_REVIEW = 1000                 # characters


def fixture_roles(spark: SparkSession) -> DataFrame:
    return word_roles(*lexicon_tables(spark, FIXTURE_LEXICON, FIXTURE_BOOSTERS,
                                      FIXTURE_NEGATORS))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return text_table(spark, sf, "documents").select("doc_id", "text")


def kept_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, tokens``: tokenized documents without NLTK stop words."""
    docs = documents(spark, sf).filter(F.col("text").isNotNull())
    return docs.select("doc_id", remove_stop_words(tokenize(F.col("text")),
                                                   NLTK_ENGLISH_STOP_WORDS).alias("tokens"))


def labelled_reviews(spark: SparkSession, sf: str, mode: str = "three_class") -> DataFrame:
    r = standin_reviews(spark, sf)
    return r.select("review_id", "text", label(F.col("stars"), mode).alias("label"))


def review_scores(spark: SparkSession, sf: str) -> DataFrame:
    reviews = standin_reviews(spark, sf).select("review_id", "text")
    return document_scores(reviews, fixture_roles(spark), id_col="review_id")


def scored_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """``review_id, text, label, vader``: three-class label and lexicon score. The
    scores are written once, so the training and the test part do not each score
    all sentences."""
    path = scratch_path(spark, "review-scores")
    write_scores(review_scores(spark, sf), path)
    return join_scores(labelled_reviews(spark, sf), read_scores(spark, path).select("review_id", "vader"))


def lexicon_predictions(spark: SparkSession, sf: str, classes: int = 3) -> DataFrame:
    reviews = standin_reviews(spark, sf).select("review_id", "stars")
    joined = join_scores(reviews, review_scores(spark, sf).select("review_id", "vader"))
    lab = three_class(F.col("stars")) if classes == 3 else binary(F.col("stars"))
    return joined.select(lab.alias("label"), polarity_class(F.col("vader"), classes).alias("prediction"))


def _round_doubles(df: DataFrame, digits: int = METRIC_DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- sources

def q_scan_reviews_json(spark, sf):
    path = scratch_path(spark, "reviews-json")
    write_reviews_json(standin_reviews(spark, sf), path)
    return read_reviews_json(spark, path)


def score_line_fixture(doc_id, quality, toxic):
    """Tuple lines in both Python forms plus unparsable lines, from ``labels``."""
    q, t, i = quality.cast("string"), toxic.cast("string"), doc_id.cast("string")
    py3 = F.concat(F.lit("('"), i, F.lit("', "), q, F.lit("."), t, F.lit("5)"))
    py2 = F.concat(F.lit("(u'"), i, F.lit("', -"), q, F.lit("."), t, F.lit("5e-02)"))
    line = (F.when((quality == 0) & (toxic == 1), F.concat(F.lit("garbage "), i))
            .when(doc_id % 2 == 0, py3).otherwise(py2))
    return F.coalesce(line, F.lit("garbage"))


def q_parse_score_lines(spark, sf):
    labels = table(spark, sf, "labels")
    path = scratch_path(spark, "score-lines")
    (labels.select(score_line_fixture(F.col("doc_id"), F.col("quality"), F.col("toxic"))
                   .alias("value")).write.text(path))
    return read_score_lines(spark, path)


def q_scores_roundtrip(spark, sf):
    path = scratch_path(spark, "scores")
    write_scores(review_scores(spark, sf), path)
    return read_scores(spark, path)


def q_project_reviews(spark, sf):
    return project_reviews(standin_reviews(spark, sf))


def quoted_line_fixture(text, turn):
    """Even turns as quoted CSV fields (inner quotes doubled), odd turns plain."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(turn % 2 == 0, quoted).otherwise(text)


def q_unquote_lines(spark, sf):
    conv = text_table(spark, sf, "conversations")
    line = quoted_line_fixture(F.col("text"), F.col("turn"))
    return conv.select("conv_id", "turn", unquote(line).alias("review"))


def q_drop_header(spark, sf):
    conv = text_table(spark, sf, "conversations")
    # Each conversation is read as one file: a header line before turn 0.
    lines = explode_values(conv, F.when(F.col("turn") == 0, F.array(F.lit(HEADER), F.col("text")))
                           .otherwise(F.array(F.col("text"))), ["conv_id", "turn"], "value")
    return drop_header(lines, HEADER)


def q_drop_first_lines(spark, sf):
    """Files of three kinds, each with its own header line, which also occurs further down."""
    part = F.col("turn") % 3
    header = F.concat(F.lit("lines"), part.cast("string"))
    line = F.when(F.col("turn") < 3, header).otherwise(F.concat_ws(
        ":", "conv_id", "turn", F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ")))
    rows = text_table(spark, sf, "conversations").select(part.alias("part"), line.alias("line"))
    base = scratch_path(spark, "headed-lines")
    for k in range(3):
        (rows.filter(F.col("part") == k).select(F.col("line").alias(f"lines{k}")).write
         .option("header", True).option("sep", "\u0001").option("quote", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{base}/{k}"))
    return drop_first_lines(spark, [f"{base}/{k}" for k in range(3)]).select("value")


# ---------------------------------------------------------------- labels, join, split

def _labelled(spark, sf, mode):
    r = standin_reviews(spark, sf)
    return r.select("review_id", "stars", label(F.col("stars"), mode).alias("label"))


def q_label_three_class(spark, sf):
    return _labelled(spark, sf, "three_class")


def q_label_binary(spark, sf):
    return _labelled(spark, sf, "binary")


def q_label_raw(spark, sf):
    return _labelled(spark, sf, "raw")


def q_join_scores(spark, sf):
    reviews = project_reviews(standin_reviews(spark, sf))
    docs = documents(spark, sf).withColumn("review_id", F.col("doc_id").cast("string"))
    scores = document_scores(docs.select("review_id", "text"), fixture_roles(spark),
                             id_col="review_id").select("review_id", "vader")
    return join_scores(reviews, scores).select("review_id", "text", "stars", "vader")


def q_split_by_key(spark, sf):
    r = standin_reviews(spark, sf)
    return r.select("review_id", split_part(F.col("review_id")).alias("part"))


def q_split_exact(spark, sf):
    r = standin_reviews(spark, sf)
    return r.select("review_id", exact_part(r, "review_id").alias("part"))


def q_split_random(spark, sf):
    r = standin_reviews(spark, sf).select("review_id")
    train, test = random_split(r)
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


# ---------------------------------------------------------------- text features

def _exploded(docs: DataFrame, arr) -> DataFrame:
    return (explode_with_position(docs, arr, ["doc_id"], "pos", "token")
            .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token"))


def q_tokenize(spark, sf):
    return _exploded(documents(spark, sf), tokenize(F.col("text")))


def q_stop_words_default(spark, sf):
    return _exploded(documents(spark, sf),
                     remove_stop_words(tokenize(F.col("text")), default_stop_words("english")))


def q_stop_words_custom(spark, sf):
    return _exploded(documents(spark, sf),
                     remove_stop_words(tokenize(F.col("text")), NLTK_ENGLISH_STOP_WORDS))


def q_hashed_tf_totals(spark, sf):
    hashed = hashed_term_frequency(kept_tokens(spark, sf), "tokens", "hashing",
                                   HASHED_CHECK_FEATURES)
    return hashed.select("doc_id", F.round(vector_total(F.col("hashing"))).cast("bigint")
                         .alias("n_terms"))


def q_term_frequency(spark, sf):
    return term_frequency(kept_tokens(spark, sf), "doc_id", "tokens")


def q_document_frequency(spark, sf):
    return document_frequency(kept_tokens(spark, sf), "tokens")


def _idf(spark, sf):
    toks = kept_tokens(spark, sf)
    n_docs = toks.count()
    return inverse_document_frequency(document_frequency(toks, "tokens"), n_docs), toks


def q_inverse_document_frequency(spark, sf):
    idf, _ = _idf(spark, sf)
    return idf.select("term", "df", F.round("idf", 6).alias("idf"))


def q_tfidf_terms(spark, sf):
    idf, toks = _idf(spark, sf)
    weighted = tfidf(term_frequency(toks, "doc_id", "tokens"), idf, "doc_id")
    return weighted.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


# ---------------------------------------------------------------- lexicon

def q_sentences_exploded(spark, sf):
    docs = documents(spark, sf)
    return (explode_with_position(docs, split_sentences(F.col("text")), ["doc_id"], "sid", "sentence")
            .select("doc_id", F.col("sid").cast("bigint").alias("sid"), "sentence"))


def q_sentences_learned(spark, sf):
    docs = documents(spark, sf)
    out = learned_sentences(docs, learn_boundaries(docs))
    return out.select("doc_id", F.col("sid").cast("bigint").alias("sid"), "sentence")


def q_lexicon_sentence(spark, sf):
    s = sentence_scores(documents(spark, sf), fixture_roles(spark))
    return s.select("doc_id", F.col("sid").cast("bigint").alias("sid"), "compound", "pos", "neu", "neg")


def q_lexicon_phrases(spark, sf):
    roles = word_roles(*lexicon_tables(spark, FIXTURE_LEXICON, FIXTURE_BOOSTERS, FIXTURE_NEGATORS, FIXTURE_PHRASES))
    s = sentence_scores(documents(spark, sf), roles)
    return s.select("doc_id", F.col("sid").cast("bigint").alias("sid"), "compound", "pos", "neu", "neg")


def q_lexicon_doc_mean(spark, sf):
    return document_scores(documents(spark, sf), fixture_roles(spark))


# ---------------------------------------------------------------- metrics

def q_metrics_micro(spark, sf):
    return _round_doubles(micro_metrics(lexicon_predictions(spark, sf)))


def q_metrics_weighted(spark, sf):
    return _round_doubles(weighted_metrics(lexicon_predictions(spark, sf)))


def q_confusion_matrix(spark, sf):
    return confusion_matrix(lexicon_predictions(spark, sf))


def q_binary_counts(spark, sf):
    return _round_doubles(binary_counts(lexicon_predictions(spark, sf, classes=2)))


# ---------------------------------------------------------------- models (property checks)

def q_assembled_features(spark, sf):
    rows = trainable(scored_reviews(spark, sf))
    train, _ = split_by_key(rows, "review_id")
    chain = build_classifier(lexicon_col="vader", num_features=ASSEMBLED_NUM_FEATURES)
    features = Pipeline(stages=chain.getStages()[:-1]).fit(train).transform(rows)
    arr = vector_to_array(F.col("features"))
    return features.select("review_id", F.size(arr).cast("bigint").alias("n_dims"),
                           F.element_at(arr, -1).alias("lexicon_value"), "vader")


def q_lr_predict(spark, sf):
    _, pred = train_and_predict(labelled_reviews(spark, sf))
    return pred


def q_lr_with_lexicon(spark, sf):
    _, pred = train_and_predict(scored_reviews(spark, sf), lexicon_col="vader")
    return pred


def q_model_roundtrip(spark, sf):
    rows = trainable(labelled_reviews(spark, sf))
    train, test = split_by_key(rows, "review_id")
    path = scratch_path(spark, "model")
    save_model(fit(build_classifier(), train), path)
    return predict(load_model(path), test, keep=("review_id", "label"))


def q_ablation_report(spark, sf):
    return ablation(spark, scored_reviews(spark, sf))


def q_ablation_interval(spark, sf):
    return ablation_interval(scored_reviews(spark, sf))


def q_paired_interval(spark, sf):
    """Two fixed predictions: always positive, and positive unless the text is long."""
    reviews = standin_reviews(spark, sf)
    long = F.length("text") > LONG_REVIEW
    pred = reviews.select("review_id", binary(F.col("stars")).alias("label"), F.lit(1.0).alias("a"),
                          F.when(long, F.lit(0.0)).otherwise(F.lit(1.0)).alias("b"))
    return _round_doubles(paired_interval(pred, "review_id"))


def q_run_report(spark, sf):
    start = time.time()
    _, pred = train_and_predict(labelled_reviews(spark, sf))
    return run_report(spark, pred, start)


def q_stream_score_reviews(spark, sf):
    rows = trainable(labelled_reviews(spark, sf))
    train, test = split_by_key(rows, "review_id")
    model_path = scratch_path(spark, "stream-model")
    save_model(fit(build_classifier(), train), model_path)
    base = scratch_path(spark, "stream")
    write_review_csv(test.select(F.col("text").alias(HEADER)), f"{base}/in")
    score_new_files(spark, f"{base}/in", load_model(model_path), f"{base}/out",
                    f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


def q_stream_batches(spark, sf):
    """The same stream into a per-batch sink, every review with its key and blanks scored."""
    rows = trainable(labelled_reviews(spark, sf))
    train, test = split_by_key(rows, "review_id")
    model = fit(build_classifier(), train)
    base = scratch_path(spark, "stream-batches")
    write_review_csv(test.select(F.col("text").alias(HEADER)), f"{base}/in")
    reviews = with_review_key(read_review_stream(spark, f"{base}/in"))
    scored = score_stream(reviews, model, keep=("review_key",), blank="score")
    start_batches(scored, folder_writer(f"{base}/out"), f"{base}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("review_key", "review", "prediction")


QUERIES = {
    "scan_reviews_json": q_scan_reviews_json,
    "parse_score_lines": q_parse_score_lines,
    "scores_roundtrip": q_scores_roundtrip,
    "project_reviews": q_project_reviews,
    "unquote_lines": q_unquote_lines,
    "drop_header": q_drop_header,
    "drop_first_lines": q_drop_first_lines,
    "label_three_class": q_label_three_class,
    "label_binary": q_label_binary,
    "label_raw": q_label_raw,
    "join_scores": q_join_scores,
    "split_by_key": q_split_by_key,
    "split_exact": q_split_exact,
    "tokenize": q_tokenize,
    "stop_words_default": q_stop_words_default,
    "stop_words_custom": q_stop_words_custom,
    "hashed_tf_totals": q_hashed_tf_totals,
    "term_frequency": q_term_frequency,
    "document_frequency": q_document_frequency,
    "inverse_document_frequency": q_inverse_document_frequency,
    "tfidf_terms": q_tfidf_terms,
    "sentences_exploded": q_sentences_exploded,
    "sentences_learned": q_sentences_learned,
    "lexicon_sentence": q_lexicon_sentence,
    "lexicon_doc_mean": q_lexicon_doc_mean,
    "lexicon_phrases": q_lexicon_phrases,
    "metrics_micro": q_metrics_micro,
    "metrics_weighted": q_metrics_weighted,
    "confusion_matrix": q_confusion_matrix,
    "binary_counts": q_binary_counts,
    "paired_interval": q_paired_interval,
    # property checks (no SQL twin)
    "split_random": q_split_random,
    "assembled_features": q_assembled_features,
    "lr_predict": q_lr_predict,
    "lr_with_lexicon": q_lr_with_lexicon,
    "model_roundtrip": q_model_roundtrip,
    "ablation_report": q_ablation_report,
    "ablation_interval": q_ablation_interval,
    "run_report": q_run_report,
    "stream_score_reviews": q_stream_score_reviews,
    "stream_batches": q_stream_batches,
}
