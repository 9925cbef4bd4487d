"""Mixing sources to target weights.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share
``total_share`` of all words; no target exceeds ``max_epochs`` times its
source's size, and the excess goes to the others by weight. Documents take a
hash-random key; keys fall into uniform ranges per source, a prefix sum over the
range totals plus one inside each range gives every document its place, and the
source is cut at its exact whole-word budget, after whole epochs where the
budget exceeds the source. One document per source may be taken in part.

Defined results: null or blank text has size 0 and takes 0; a null source is a
source of its own; repeated rows count as separate documents; null doc_id
is keyed by its own constant; an empty table gives no rows and extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
ROWS_PER_RANGE = 20_000


def hash_key(doc_id: Column, seed: int = 0) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")),
                          F.lit(f":{seed}")).cast("binary"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: its size, rows and target. ``sizes`` has _src, size.

    The fixed point of resharing the excess is target = min(cap, level * weight)
    for one common level. With sources in order of cap / weight, the level is the
    largest of (words left) / (weight left) over the order. The windows
    hold one row per source, not per document.
    """
    per = sizes.groupBy("_src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(Window.orderBy("_src")) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", pick).withColumn("_cap", F.col("source_size") * float(max_epochs))
    before = Window.orderBy(F.col("_cap") / F.col("_w"), "_src").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = (F.sum("source_size").over(whole) * float(total_share)
            - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
    w_left = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    per = per.withColumn("_lam", left / w_left)
    return per.select("_src", "source_size", "_rows",
                      F.least("_cap", F.max("_lam").over(whole) * F.col("_w")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
        max_epochs: int = MAX_EPOCHS, seed: int = 0,
        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``
    (doc_id, text, source)."""
    sizes = written(docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("z")).alias("_src"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hash_key(F.col("doc_id"), seed).alias("_key")), "mix-sizes")
    targets = source_targets(sizes, weights, total_share, max_epochs).withColumn(
        "_ranges", F.ceil(F.col("_rows") / rows_per_range))
    # One narrow row per source: as many as the mix has weights to set.
    placed = sizes.join(targets, "_src").withColumn("_range", F.floor(
        F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.col("_ranges") / F.lit(2.0 ** 32)))
    totals = placed.groupBy("_src", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_src", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy("_src", "_range").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    taken = (epochs * F.col("size")
             + F.greatest(F.lit(0), F.least(F.col("size"), budget - epochs * F.col("source_size") - start)))
    return (placed.join(offsets, ["_src", "_range"])
            .select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                    taken.cast("long").alias("taken")))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce('s' || source, 'z') AS src,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, 'null') || ':0') AS k FROM {docs}),
p AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT]::DOUBLE AS wt, source_size * 2.0::DOUBLE AS cap FROM p),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)::DOUBLE)
    / ((sum(wt) OVER ()) - coalesce(sum(wt) OVER b, 0)) AS lam FROM w
    WINDOW b AS (ORDER BY cap / wt, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT src, source_size, least(cap, (max(lam) OVER ()) * wt)::DOUBLE AS target FROM l),
s AS (SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
    CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY src ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d JOIN t USING (src))
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - start)))::BIGINT AS taken FROM s
"""
