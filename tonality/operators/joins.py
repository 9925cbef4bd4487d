"""Joins, and the size check that guards every explicit broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dictionary-like sides (lexicons, IDF tables) up to this many rows are
# broadcast; beyond it the join shuffles (salted where a key may be hot).
MAX_BROADCAST_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads no more than needed)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS
                       ) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when its row count is proven small, else ``(df, False)``."""
    if row_count_at_most(df, max_rows):
        return F.broadcast(df), True
    return df, False


def salted_join(big: DataFrame, small: DataFrame, on: str, spread_by: str,
                buckets: int, how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where one ``on`` value may hold a large share of
    ``big``: ``big`` rows take a salt from ``spread_by`` and ``small`` rows are
    replicated once per salt, so a hot key spreads over ``buckets`` tasks."""
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread_by)), F.lit(buckets)))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_big.join(salted_small, [on, "_salt"], how).drop("_salt")


def join_scores(reviews: DataFrame, scores: DataFrame, key: str = "review_id",
                how: str = "inner", fill: dict | None = None) -> DataFrame:
    """Reviews with their per-review score: one key column out, reviews'
    columns first. Inner by default (a review without a score drops out);
    ``how="left"`` keeps it, with ``fill`` (e.g. ``{"vader": 0.0}``) for the
    missing score. Scores hold one row per key, so the join is many-to-one:
    in a sort-merge join a hot review key streams on the reviews side against
    one buffered score row, and AQE splits its partition; Catalyst/AQE pick a
    broadcast when the scores are under the runtime size threshold."""
    joined = reviews.join(scores, key, how)
    return joined.fillna(fill) if fill else joined
