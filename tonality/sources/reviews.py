"""Review tables: JSON-lines scan with an explicit schema, and the stand-in
review table built from the driver's ``documents`` and ``labels``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.schemas import REVIEW
from tonality.session import table, text_table

REVIEW_COLUMNS = ("review_id", "text", "stars")


def read_reviews_json(spark: SparkSession, path: str, mode: str = "PERMISSIVE",
                      corrupt_column: str | None = None) -> DataFrame:
    """JSON-lines reviews with the fixed ``REVIEW`` schema (no inference scan).

    ``mode`` is Spark's JSON parse mode; ``corrupt_column`` keeps unparsable
    lines in an extra string column.
    """
    schema = REVIEW
    reader = spark.read.option("mode", mode)
    if corrupt_column:
        schema = REVIEW.add(corrupt_column, "string")
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).json(path)


def write_reviews_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def project_reviews(df: DataFrame) -> DataFrame:
    """The three working columns; Catalyst prunes the rest from the scan."""
    return df.select(*REVIEW_COLUMNS)


def standin_stars(quality: Column, toxic: Column) -> Column:
    """Star rating stand-in: good & clean 5, good & toxic 3, poor & clean 2,
    poor & toxic 1; anything else null."""
    return (F.when((quality == 1) & (toxic == 0), F.lit(5.0))
            .when((quality == 1) & (toxic == 1), F.lit(3.0))
            .when((quality == 0) & (toxic == 0), F.lit(2.0))
            .when((quality == 0) & (toxic == 1), F.lit(1.0)))


def standin_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review table stand-in: ``documents`` joined to ``labels`` on ``doc_id``.

    The driver's tables have no star column, so stars derive from the labels
    (``standin_stars``). Columns follow ``REVIEW``; ``review_id`` is the
    document id as a string. The join is left to Catalyst/AQE: it becomes a
    broadcast only when the runtime size of ``labels`` is under the threshold,
    otherwise a sort-merge join whose hash partitioning on ``doc_id`` later
    per-document aggregations reuse.
    """
    docs = text_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    joined = docs.join(labels, "doc_id")
    return joined.select(
        F.col("source").alias("business_id"),
        F.lit(None).cast("long").alias("cool"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("long").alias("funny"),
        F.col("doc_id").cast("string").alias("review_id"),
        standin_stars(F.col("quality"), F.col("toxic")).alias("stars"),
        F.col("text"),
        F.lit(None).cast("long").alias("useful"),
        F.lit(None).cast("string").alias("user_id"),
    )
