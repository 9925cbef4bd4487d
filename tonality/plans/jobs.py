"""End-to-end jobs: the three programs a user of the reference runs.

- ``classify_reviews``: JSON reviews -> label -> (join lexicon scores) ->
  key split -> fit the chain -> test predictions -> save model -> metrics ->
  one-row run report (JSON). With ``scores_path`` it is the lexicon variant.
- ``score_reviews``: JSON reviews -> per-review mean lexicon score, written
  as parquet (or as tuple text lines with ``fmt="text"``).
- ``stream_reviews``: new CSV review files -> saved chain -> parquet, until
  stopped (or once over what is there with ``available_now``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.functions.labels import label
from tonality.operators.joins import join_scores
from tonality.operators.lexicon import document_scores, word_roles
from tonality.operators.split import split_by_key
from tonality.plans.classifier import build_classifier, fit, predict, run_report, trainable
from tonality.schemas import BOOSTERS, LEXICON, NEGATORS
from tonality.sinks.reports import write_report
from tonality.sources.models import load_model, save_model
from tonality.sources.reviews import project_reviews, read_reviews_json
from tonality.sources.scores import read_score_lines, read_scores, write_score_lines, write_scores
from tonality.streaming.score_stream import read_review_stream, score_stream, start_scoring


def read_word_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A word table from CSV with a header (``token[,valence|incr]``) or parquet."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.schema(schema).option("header", True).csv(path)


def read_any_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores as parquet, or as tuple text lines."""
    try:
        return read_scores(spark, path).select("review_id", "vader")
    except Exception:  # noqa: BLE001 - not parquet: the tuple-text form
        return read_score_lines(spark, path).filter(F.col("review_id").isNotNull())


def classify_reviews(spark: SparkSession, reviews_path: str, report_path: str,
                     model_path: str | None = None, label_mode: str = "raw",
                     scores_path: str | None = None, average: str = "micro",
                     **params) -> DataFrame:
    """Train and evaluate; returns the run report (also written to ``report_path``)."""
    start = time.time()
    reviews = project_reviews(read_reviews_json(spark, reviews_path))
    rows = reviews.select("review_id", "text", label(F.col("stars"), label_mode).alias("label"))
    lexicon_col = None
    if scores_path:
        rows = join_scores(rows, read_any_scores(spark, scores_path))
        lexicon_col = "vader"
    train, test = split_by_key(trainable(rows), "review_id")
    model = fit(build_classifier(lexicon_col=lexicon_col, **params), train)
    if model_path:
        save_model(model, model_path)
    report = run_report(spark, predict(model, test), start, average)
    write_report(report, report_path)
    return report


def score_reviews(spark: SparkSession, reviews_path: str, lexicon_path: str, out_path: str,
                  boosters_path: str | None = None, negators_path: str | None = None,
                  fmt: str = "parquet") -> None:
    """Per-review mean lexicon score (``review_id, vader``)."""
    reviews = read_reviews_json(spark, reviews_path).select("review_id", "text")
    roles = word_roles(read_word_table(spark, lexicon_path, LEXICON),
                       read_word_table(spark, boosters_path, BOOSTERS) if boosters_path else None,
                       read_word_table(spark, negators_path, NEGATORS) if negators_path else None)
    scores = document_scores(reviews, roles, id_col="review_id").select("review_id", "vader")
    if fmt == "text":
        write_score_lines(scores, out_path)
    else:
        write_scores(scores, out_path)


def stream_reviews(spark: SparkSession, model_path: str, input_dir: str, output_dir: str,
                   checkpoint_dir: str, trigger: str = "10 seconds",
                   available_now: bool = False, timeout: float | None = None):
    """Score new review files with a saved chain; returns the streaming query."""
    scored = score_stream(read_review_stream(spark, input_dir), load_model(model_path))
    query = start_scoring(scored, output_dir, checkpoint_dir, trigger=trigger,
                          available_now=available_now)
    if available_now or timeout:
        query.awaitTermination(timeout)
    return query
