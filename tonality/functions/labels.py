"""Labels from star ratings. A null rating gives a null label in every mode
(never a class), so unlabeled rows are dropped before a fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("three_class", "binary", "raw")


def three_class(stars: Column) -> Column:
    """Below 3 -> 1.0, exactly 3 -> 2.0, above 3 -> 3.0."""
    return (F.when(stars < 3, F.lit(1.0))
            .when(stars > 3, F.lit(3.0))
            .when(stars == 3, F.lit(2.0)))


def binary(stars: Column) -> Column:
    """Above 3 -> 1.0, otherwise 0.0."""
    return F.when(stars > 3, F.lit(1.0)).when(stars <= 3, F.lit(0.0))


def raw(stars: Column) -> Column:
    """The rating itself as a (five-class) label."""
    return stars.cast("double")


def label(stars: Column, mode: str = "three_class") -> Column:
    if mode not in MODES:
        raise ValueError(f"label mode must be one of {MODES}, got {mode!r}")
    return {"three_class": three_class, "binary": binary, "raw": raw}[mode](stars)


def with_label(df: DataFrame, mode: str = "three_class", stars_col: str = "stars",
               label_col: str = "label") -> DataFrame:
    return df.withColumn(label_col, label(F.col(stars_col), mode))
