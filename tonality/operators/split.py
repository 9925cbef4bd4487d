"""Train/test splits.

``split_by_key`` is reproducible whatever the partitioning: a row goes to
train when an md5 bucket of ``seed:key`` is below the train percentage. It is
a narrow filter (no shuffle, no sort). ``exact_split`` is as reproducible and
gives train exactly its share of the different keys: the hash of the last key
to take is found by refining histograms, without a sort. ``random_split`` is
Spark's seeded ``randomSplit``, whose parts depend on the input partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.fixed import SPLIT_SEED, SPLIT_WEIGHTS
from tonality.session import scratch_path

HASH_DIGITS = 15                   # hexadecimal digits of a key's hash: 60 bits
STEP_BITS = 15                     # bits of the hash that one histogram settles
MILLION = 1_000_000


def key_bucket(key: Column, seed: int = SPLIT_SEED) -> Column:
    """0..99 from the first 32 bits of md5(``seed:key``)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def split_part(key: Column, train_fraction: float = SPLIT_WEIGHTS[0],
               seed: int = SPLIT_SEED) -> Column:
    cut = int(round(train_fraction * 100))
    return F.when(key_bucket(key, seed) < cut, F.lit("train")).otherwise(F.lit("test"))


def split_by_key(df: DataFrame, key: str, train_fraction: float = SPLIT_WEIGHTS[0],
                 seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    part = split_part(F.col(key), train_fraction, seed)
    return df.filter(part == "train"), df.filter(part == "test")


def key_hash(key: Column, seed: int = SPLIT_SEED) -> Column:
    """60 bits of md5(``seed:key``) as a long."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def kth_smallest(hashes: DataFrame, k: int) -> tuple[int, int]:
    """The k-th smallest ``h`` (k from 1, at most the number of rows) and how many
    of the rows equal to it are among the first k. Every pass counts the rows that
    share the bits found so far by their next bits, so it returns at most
    2 ** STEP_BITS counts, however many rows there are."""
    found, left = 0, k
    for shift in range(4 * HASH_DIGITS - STEP_BITS, -1, -STEP_BITS):
        digit = F.shiftright("h", shift).bitwiseAND(F.lit((1 << STEP_BITS) - 1))
        counts = (hashes.filter(F.shiftright("h", shift + STEP_BITS) == found)
                  .groupBy(digit.alias("digit")).count().collect())
        for row in sorted(counts):
            if left <= row["count"]:
                found = found << STEP_BITS | row["digit"]
                break
            left -= row["count"]
        else:
            raise ValueError("k is larger than the number of rows")
    return found, left


def exact_part(df: DataFrame, key: str, train_fraction: float = SPLIT_WEIGHTS[0],
               seed: int = SPLIT_SEED) -> Column:
    """``train`` or ``test`` for the rows of ``df``: of its n different non-null keys
    exactly train_fraction * n, rounded (halves up), are in train, those with the smallest hashes
    (equal hashes by key). All rows of a key share a part; null keys are in test.
    Runs one job over the keys and four over their written hashes."""
    spark = df.sparkSession
    path = scratch_path(spark, "split-keys")
    names = df.select(F.col(key).cast("string").alias("name")).filter("name IS NOT NULL").distinct()
    names.select(key_hash(F.col("name"), seed).alias("h"), "name").write.parquet(path)
    hashes = spark.read.schema("h long, name string").parquet(path)
    take = (hashes.count() * round(train_fraction * MILLION) + MILLION // 2) // MILLION
    if take == 0:
        return F.lit("test")
    last, ties = kth_smallest(hashes.select("h"), take)
    name = hashes.filter(F.col("h") == last).orderBy("name").limit(ties).agg(F.max("name")).first()[0]
    h = key_hash(F.col(key), seed)
    first = (h < last) | ((h == last) & (F.col(key).cast("string") <= name))
    return F.when(first, F.lit("train")).otherwise(F.lit("test"))


def exact_split(df: DataFrame, key: str, train_fraction: float = SPLIT_WEIGHTS[0],
                seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    part = exact_part(df, key, train_fraction, seed)
    return df.filter(part == "train"), df.filter(part == "test")


def random_split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED
                 ) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)
