"""Classification metrics, all derived from one confusion table.

The prediction table is read once: ``groupBy(label, prediction).count()``
with map-side partial aggregation leaves at most classes x classes rows, and
every metric below is computed from that small table.

Two families, kept apart on purpose:
- ``micro_metrics``: precision, recall and F1 summed over all classes, which
  all equal accuracy for single-label data.
- ``weighted_metrics``: per-class precision, recall and F1 weighted by each
  true class's share of rows; a class with a zero denominator scores 0.
  Classes are the true labels present (a phantom class 0 never appears).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(pred: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction") -> DataFrame:
    """Long form ``label, prediction, n``; only cells that occur."""
    return (pred.groupBy(F.col(label_col).alias("label"),
                         F.col(prediction_col).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def _ratio(num, den):
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def micro_metrics(pred: DataFrame, label_col: str = "label",
                  prediction_col: str = "prediction") -> DataFrame:
    """One row: ``accuracy, precision, recall, f1, total``."""
    cm = confusion_matrix(pred, label_col, prediction_col)
    agg = cm.agg(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                       .otherwise(F.lit(0))).alias("hit"),
                 F.sum("n").alias("total"))
    acc = _ratio(F.col("hit"), F.col("total"))
    return agg.select(acc.alias("accuracy"), acc.alias("precision"), acc.alias("recall"),
                      acc.alias("f1"), F.coalesce(F.col("total"), F.lit(0)).cast("bigint").alias("total"))


def class_stats(cm: DataFrame) -> DataFrame:
    """Per class: ``cls, actual, predicted, tp`` from a confusion table."""
    as_label = cm.select(F.col("label").alias("cls"), F.col("n").alias("actual"),
                         F.lit(0).cast("bigint").alias("predicted"),
                         F.when(F.col("label") == F.col("prediction"), F.col("n"))
                         .otherwise(F.lit(0)).cast("bigint").alias("tp"))
    as_pred = cm.select(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("actual"),
                        F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp"))
    return (as_label.unionByName(as_pred).groupBy("cls")
            .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"),
                 F.sum("tp").alias("tp")))


def weighted_metrics(pred: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction") -> DataFrame:
    """One row: ``accuracy, weighted_precision, weighted_recall, weighted_f1, total``."""
    stats = class_stats(confusion_matrix(pred, label_col, prediction_col))
    stats = stats.filter(F.col("actual") > 0)
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("actual"))
    per_class = stats.select(
        "actual", "tp", precision.alias("p"), recall.alias("r"))
    f1 = F.when(F.col("p") + F.col("r") == 0, F.lit(0.0)).otherwise(
        2.0 * F.col("p") * F.col("r") / (F.col("p") + F.col("r")))
    per_class = per_class.withColumn("f1", f1)
    total = F.sum("actual")
    agg = per_class.agg(
        total.alias("total"), F.sum("tp").alias("hit"),
        F.sum(F.col("actual") * F.col("p")).alias("wp"),
        F.sum(F.col("actual") * F.col("r")).alias("wr"),
        F.sum(F.col("actual") * F.col("f1")).alias("wf"))
    return agg.select(
        _ratio(F.col("hit"), F.col("total")).alias("accuracy"),
        _ratio(F.col("wp"), F.col("total")).alias("weighted_precision"),
        _ratio(F.col("wr"), F.col("total")).alias("weighted_recall"),
        _ratio(F.col("wf"), F.col("total")).alias("weighted_f1"),
        F.coalesce(F.col("total"), F.lit(0)).cast("bigint").alias("total"))


def binary_counts(pred: DataFrame, label_col: str = "label",
                  prediction_col: str = "prediction", positive: float = 1.0) -> DataFrame:
    """One row: ``tp, tn, fp, fn, total, recall, precision`` for a binary label."""
    cm = confusion_matrix(pred, label_col, prediction_col)
    is_pos_l = F.col("label") == positive
    is_pos_p = F.col("prediction") == positive

    def cell(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    agg = cm.agg(cell(is_pos_l & is_pos_p).alias("tp"), cell(~is_pos_l & ~is_pos_p).alias("tn"),
                 cell(~is_pos_l & is_pos_p).alias("fp"), cell(is_pos_l & ~is_pos_p).alias("fn"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"))
    return agg.select("tp", "tn", "fp", "fn", "total",
                      _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                      _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def metrics_from_counts(tp: int, tn: int, fp: int, fn: int) -> dict:
    """Plain-number twin of ``binary_counts`` (for published count tuples)."""
    total = tp + tn + fp + fn
    return {"tp": tp, "tn": tn, "fp": fp, "fn": fn, "total": total,
            "recall": tp / (tp + fn) if tp + fn else 0.0,
            "precision": tp / (tp + fp) if tp + fp else 0.0,
            "accuracy": (tp + tn) / total if total else 0.0}
