"""Paired resampling of two predictions for the same rows.

A replicate draws every row a Poisson(1) number of times. The draw is a
function of ``seed:replicate:key``, so it needs no random state, gives the same
figures whatever the partitioning, and both predictions get the same draws.
All replicates are sums of one aggregate with partial aggregation: every task
ships one row a replicate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.fixed import SPLIT_SEED

REPLICATES = 200
LEVEL = 0.95
DRAW_DIGITS = 7                    # hexadecimal digits of a draw: 28 bits
MOST_DRAWS = 9                     # the chance of more is below 2 ** -20


def draw_thresholds() -> list[int]:
    """A draw of 28 bits counts once for every threshold it reaches: the Poisson(1)
    distribution function in units of 2 ** -28."""
    chance = [math.exp(-1) / math.factorial(k) for k in range(MOST_DRAWS)]
    return [math.ceil(sum(chance[:k + 1]) * 16 ** DRAW_DIGITS) for k in range(MOST_DRAWS)]


def draws(key: Column, replicate: Column, seed: int = SPLIT_SEED) -> Column:
    """How often the row of ``key`` is drawn in ``replicate``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), replicate.cast("string"), F.lit(":"), key.cast("string")))
    u = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("bigint")
    # One comparison chain from the top, since most draws are 0 or 1.
    times = F.when(u < draw_thresholds()[0], F.lit(0))
    for k, cut in enumerate(draw_thresholds()[1:], 1):
        times = times.when(u < cut, F.lit(k))
    return times.otherwise(F.lit(MOST_DRAWS)).cast("bigint")


def replicate_counts(pred: DataFrame, key: str, label: str, a: str, b: str,
                     replicates: int = REPLICATES, seed: int = SPLIT_SEED) -> DataFrame:
    """``replicate, n, right_a, right_b``; replicate 0 holds every row once, the resampled ones
    count from 1. Rows with a null key or label take no part, a null prediction is wrong."""
    rows = pred.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(a).eqNullSafe(F.col(label)).cast("bigint").alias("a"),
        F.col(b).eqNullSafe(F.col(label)).cast("bigint").alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("replicate"))
    times = F.when(F.col("replicate") == 0, F.lit(1).cast("bigint")).otherwise(draws(F.col("key"), F.col("replicate"), seed))
    return rows.select("replicate", times.alias("t"), "a", "b").groupBy("replicate").agg(
        F.sum("t").alias("n"), F.sum(F.col("t") * F.col("a")).alias("right_a"),
        F.sum(F.col("t") * F.col("b")).alias("right_b"))


def paired_interval(pred: DataFrame, key: str, label: str = "label", a: str = "a", b: str = "b",
                    replicates: int = REPLICATES, level: float = LEVEL, seed: int = SPLIT_SEED) -> DataFrame:
    """One row ``total, accuracy_a, accuracy_b, gain, low, high``: the accuracies of two
    predictions, b's gain over a, and the percentile interval of the gain over the replicates. A
    table without rows gives total 0 and nulls."""
    counts = replicate_counts(pred, key, label, a, b, replicates, seed)
    share = lambda c: F.when(F.col("n") > 0, c / F.col("n"))
    gain = share(F.col("right_b") - F.col("right_a"))
    whole = F.col("replicate") == 0
    one = counts.agg(
        F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0).cast("bigint")).alias("total"),
        F.max(F.when(whole, share(F.col("right_a")))).alias("accuracy_a"),
        F.max(F.when(whole, share(F.col("right_b")))).alias("accuracy_b"),
        F.max(F.when(whole, gain)).alias("gain"),
        F.sort_array(F.collect_list(F.when(~whole, gain))).alias("gains"))
    below = F.floor(F.size("gains") * F.lit((1 - level) / 2)).cast("int")
    return one.select("total", "accuracy_a", "accuracy_b", "gain", F.get("gains", below).alias("low"),
                      F.get("gains", F.size("gains") - 1 - below).alias("high"))
