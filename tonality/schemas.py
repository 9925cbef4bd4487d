"""Explicit schemas: no inference pass over the input, and types cannot drift."""

from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)

# JSON review record (all fields nullable, as the review dump has them).
REVIEW = StructType([
    StructField("business_id", StringType()),
    StructField("cool", LongType()),
    StructField("date", StringType()),
    StructField("funny", LongType()),
    StructField("review_id", StringType()),
    StructField("stars", DoubleType()),
    StructField("text", StringType()),
    StructField("useful", LongType()),
    StructField("user_id", StringType()),
])

SCORE = StructType([
    StructField("review_id", StringType()),
    StructField("vader", DoubleType()),
])

LEXICON = StructType([
    StructField("token", StringType()),
    StructField("valence", DoubleType()),
])

BOOSTERS = StructType([
    StructField("token", StringType()),
    StructField("incr", DoubleType()),
])

NEGATORS = StructType([StructField("token", StringType())])

PHRASES = StructType([
    StructField("phrase", StringType()),
    StructField("valence", DoubleType()),
    StructField("incr", DoubleType()),
    StructField("neg", BooleanType()),
    StructField("factor", DoubleType()),
    StructField("near", BooleanType()),
])

STREAM_REVIEW = StructType([StructField("review", StringType())])

RUN_REPORT = StructType([
    StructField("accuracy", DoubleType()),
    StructField("total", LongType()),
    StructField("precision", DoubleType()),
    StructField("recall", DoubleType()),
    StructField("f1", DoubleType()),
    StructField("start", DoubleType()),
    StructField("end", DoubleType()),
    StructField("total_time", DoubleType()),
])

BINARY_REPORT = StructType([
    StructField("tp", LongType()),
    StructField("tn", LongType()),
    StructField("fp", LongType()),
    StructField("fn", LongType()),
    StructField("total", LongType()),
    StructField("recall", DoubleType()),
    StructField("precision", DoubleType()),
    StructField("start", DoubleType()),
    StructField("end", DoubleType()),
    StructField("total_time", DoubleType()),
])
