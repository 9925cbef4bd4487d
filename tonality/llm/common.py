"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: cuts
    lineage with files that outlive any executor. ``codec``: a Parquet compression
    other than the session's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
