"""Array-to-rows helpers.

A plain ``explode`` makes the optimizer infer ``size(array) > 0`` and push it
below the projection that builds the array; the array expression is then
inlined there and evaluated again (for arrays built from other arrays by
lambdas, once per element). ``posexplode_outer`` infers no such filter; the
outer row it adds for a null or empty array is the only row whose position
is null, so filtering on the position gives exactly ``explode``'s rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_with_position(df: DataFrame, array: Column, keep, pos: str = "pos",
                          value: str = "value") -> DataFrame:
    """``keep`` columns plus one row per element: 0-based ``pos`` and ``value``."""
    out = df.select(*keep, F.posexplode_outer(array).alias(pos, value))
    return out.filter(F.col(pos).isNotNull())


def explode_values(df: DataFrame, array: Column, keep, value: str = "value") -> DataFrame:
    """``keep`` columns plus one row per element (no position)."""
    return explode_with_position(df, array, keep, "_pos", value).drop("_pos")
