"""Score newly arriving review files with a saved classifier (Structured Streaming).

Source: a directory of CSV files with a ``review`` header line (quoted
fields may hold commas, line breaks and doubled quotes). Each micro-batch
runs the fitted chain's ``transform`` directly on the streaming DataFrame;
the file sink with a checkpoint gives exactly-once output, and a restarted
query on the same checkpoint reads only files it has not seen.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonality.schemas import STREAM_REVIEW
from tonality.sources.review_files import csv_reader

DEFAULT_TRIGGER = "10 seconds"


def read_review_stream(spark: SparkSession, input_dir: str, schema=STREAM_REVIEW,
                       header: bool = True, max_files_per_trigger: int | None = None
                       ) -> DataFrame:
    reader = csv_reader(spark.readStream, schema, header)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(input_dir)


def with_review_key(reviews: DataFrame, review_col: str = "review", key_col: str = "review_key") -> DataFrame:
    """Streamed rows plus ``key_col``, by which a score finds its review again: md5 of the file's
    path and the text (a blank field counts as empty). Equal rows of one file share it."""
    text = F.coalesce(F.col(review_col), F.lit(""))
    return reviews.withColumn(key_col, F.md5(F.concat_ws("\n", F.col("_metadata.file_path"), text).cast("binary")))


def score_stream(reviews: DataFrame, model: PipelineModel, review_col: str = "review",
                 keep: tuple[str, ...] = (), blank: str = "drop") -> DataFrame:
    """``review, prediction`` (plus ``keep`` columns) for each streamed row.

    A blank field of a CSV file arrives as null, which the tokenizer rejects:
    ``blank="drop"`` leaves such rows out, ``"score"`` scores them as empty text."""
    if blank not in ("drop", "score"):
        raise ValueError("blank must be 'drop' or 'score'")
    if blank == "score":
        reviews = reviews.withColumn(review_col, F.coalesce(F.col(review_col), F.lit("")))
    rows = reviews.filter(reviews[review_col].isNotNull())
    rows = rows.withColumnRenamed(review_col, "text") if review_col != "text" else rows
    scored = model.transform(rows)
    return scored.select(*keep, scored["text"].alias(review_col), "prediction")


def start_scoring(scored: DataFrame, output_dir: str, checkpoint_dir: str,
                  trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                  fmt: str = "parquet") -> StreamingQuery:
    """Append the scored rows to ``output_dir``. ``available_now`` processes
    what is there and stops; otherwise a processing-time trigger."""
    writer = (scored.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=trigger or DEFAULT_TRIGGER)
    return writer.start(output_dir)


def score_new_files(spark: SparkSession, input_dir: str, model: PipelineModel,
                    output_dir: str, checkpoint_dir: str, timeout: float | None = None
                    ) -> StreamingQuery:
    """Process every file not yet seen under ``checkpoint_dir`` and stop."""
    query = start_scoring(score_stream(read_review_stream(spark, input_dir), model),
                          output_dir, checkpoint_dir, available_now=True)
    query.awaitTermination(timeout)
    return query
