"""CSV review files (one ``review`` column, header line, RFC-4180 quoting)
and the line-level helpers for files read as plain text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.schemas import STREAM_REVIEW


def unquote(line: Column) -> Column:
    """A quoted CSV field without its quotes and with ``""`` unescaped;
    a plain field is returned unchanged."""
    quoted = line.startswith('"') & line.endswith('"') & (F.length(line) >= 2)
    inner = F.substring(line, F.lit(2), F.length(line) - 2)
    return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(line)


def drop_header(lines: DataFrame, header: str, col: str = "value") -> DataFrame:
    """Every line equal to the header text removed (null lines kept)."""
    return lines.filter(~F.col(col).eqNullSafe(F.lit(header)))


def _placed_lines(spark: SparkSession, path) -> DataFrame:
    """Every line with its file, where its block starts and a number that grows
    along the block."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"))


def first_lines(spark: SparkSession, path) -> DataFrame:
    """``file_path, header, line``: the first line of every file that has one. A
    minimum per file over first blocks: no sort, one row a file and task is shuffled."""
    return (_placed_lines(spark, path).filter("block = 0").groupBy("file_path")
            .agg(F.min_by("value", "line").alias("header"), F.min("line").alias("line")))


def drop_first_lines(spark: SparkSession, path) -> DataFrame:
    """``value, file_path``: all lines but the first of every file, whatever the
    headers are; equal lines further down stay. A file of one line gives no
    row, and so does an empty one. Both reads of the files have the same splits, so a line has
    the same number in both; the numbers to drop are one a file."""
    first = first_lines(spark, path).select("line")
    return _placed_lines(spark, path).join(first, "line", "left_anti").select("value", "file_path")


# Field separator for one-column review files: a character that never occurs
# in text, so a comma in an unquoted review stays part of the review.
SINGLE_COLUMN_SEP = "\u0001"


def csv_reader(reader, schema=STREAM_REVIEW, header: bool = True):
    """CSV options shared by the batch and the streaming reader: header line,
    RFC-4180 quoting (``""`` inside quotes), quoted line breaks. A one-column
    schema reads each record whole (see ``SINGLE_COLUMN_SEP``)."""
    reader = (reader.schema(schema)
              .option("header", header)
              .option("quote", '"')
              .option("escape", '"')
              .option("multiLine", True))
    if len(schema.fields) == 1:
        reader = reader.option("sep", SINGLE_COLUMN_SEP)
    return reader


def read_review_csv(spark: SparkSession, path: str, schema=STREAM_REVIEW,
                    header: bool = True) -> DataFrame:
    return csv_reader(spark.read, schema, header).csv(path)


def write_review_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line and doubled quotes inside quoted fields."""
    (df.write.mode(mode).option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))
