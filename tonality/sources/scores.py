"""Per-review score tables: the tuple-text form and typed parquet.

The text form has one Python tuple per line, ``('id', 0.1234)`` or, as
Python 2 wrote it, ``(u'id', 0.1234)``. Both parse; any other line gives
nulls in both columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCORE_LINE = r"^\(u?'([^']*)', *([^)]+)\)$"


def parse_score_line(line: Column) -> tuple[Column, Column]:
    review_id = F.nullif(F.regexp_extract(line, SCORE_LINE, 1), F.lit(""))
    vader = F.regexp_extract(line, SCORE_LINE, 2).try_cast("double")
    return review_id, vader


def parse_score_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    review_id, vader = parse_score_line(F.col(col))
    return lines.select(review_id.alias("review_id"), vader.alias("vader"))


def read_score_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_score_lines(spark.read.text(path))


def format_score_lines(scores: DataFrame, id_col: str = "review_id",
                       score_col: str = "vader") -> DataFrame:
    """The tuple-text form, one line per score (column ``value``)."""
    line = F.concat(F.lit("('"), F.col(id_col).cast("string"), F.lit("', "),
                    F.col(score_col).cast("string"), F.lit(")"))
    return scores.select(line.alias("value"))


def write_score_lines(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    format_score_lines(scores).write.mode(mode).text(path)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    scores.write.mode(mode).parquet(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
