import random

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tonality.operators.metrics import (binary_counts, confusion_matrix, metrics_from_counts,
                                        micro_metrics, weighted_metrics)

GOLDEN = [
    ((828962, 377752, 79923, 51000), 1337637, 0.9420429518547392, 0.9120647826732755, 0.9021236703231146),
    ((830903, 377859, 78284, 49345), 1336391, 0.943941934545719, 0.9138967011186917, 0.9044972616547103),
]


def test_golden_counts_arithmetic():
    for (tp, tn, fp, fn), total, recall, precision, accuracy in GOLDEN:
        m = metrics_from_counts(tp, tn, fp, fn)
        assert m["total"] == total
        assert m["recall"] == recall and m["precision"] == precision
        assert abs(m["accuracy"] - accuracy) < 1e-15


def test_binary_counts_on_golden_table(spark):
    (tp, tn, fp, fn), total, recall, precision, _ = GOLDEN[0]
    ids = spark.range(total)
    c1, c2, c3 = tp, tp + tn, tp + tn + fp
    pred = ids.select(
        F.when(F.col("id") < c1, 1.0).when(F.col("id") < c2, 0.0).when(F.col("id") < c3, 0.0)
        .otherwise(1.0).alias("label"),
        F.when(F.col("id") < c1, 1.0).when(F.col("id") < c2, 0.0).when(F.col("id") < c3, 1.0)
        .otherwise(0.0).alias("prediction"))
    r = binary_counts(pred).collect()[0]
    assert (r.tp, r.tn, r.fp, r.fn, r.total) == (tp, tn, fp, fn, total)
    assert r.recall == recall and r.precision == precision


def _random_predictions(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        label = rnd.choice([1.0, 2.0, 3.0, 3.0, 3.0])
        pred = label if rnd.random() < 0.6 else rnd.choice([1.0, 2.0, 3.0, 0.0])
        rows.append((label, pred))
    return spark.createDataFrame(rows, "label double, prediction double")


def test_weighted_metrics_equal_mllib_evaluator(spark):
    pred = _random_predictions(spark)
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    want = {m: ev.setMetricName(m).evaluate(pred)
            for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1")}
    got = weighted_metrics(pred).collect()[0]
    assert abs(got.accuracy - want["accuracy"]) < 1e-12
    assert abs(got.weighted_precision - want["weightedPrecision"]) < 1e-12
    assert abs(got.weighted_recall - want["weightedRecall"]) < 1e-12
    assert abs(got.weighted_f1 - want["f1"]) < 1e-12
    assert got.total == 3000


def test_micro_metrics_all_equal_accuracy_and_matrix_sums(spark):
    pred = _random_predictions(spark)
    m = micro_metrics(pred).collect()[0]
    assert m.accuracy == m.precision == m.recall == m.f1
    cm = confusion_matrix(pred).collect()
    assert sum(r.n for r in cm) == 3000 == m.total
    assert abs(m.accuracy - sum(r.n for r in cm if r.label == r.prediction) / 3000) < 1e-15
    assert 0.0 not in {r.label for r in cm}        # phantom class 0 only as a prediction


def test_empty_predictions(spark):
    pred = spark.createDataFrame([], "label double, prediction double")
    assert micro_metrics(pred).collect()[0].total == 0
    assert weighted_metrics(pred).collect()[0].accuracy == 0.0
