from pyspark.sql import functions as F

from tonality.functions.labels import label, with_label
from tonality.operators.split import random_split, split_by_key


def test_label_modes_and_null_stars(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (3.0,), (4.0,), (5.0,), (None,)], "stars double")
    rows = df.select("stars", label(F.col("stars"), "three_class").alias("t"),
                     label(F.col("stars"), "binary").alias("b"),
                     label(F.col("stars"), "raw").alias("r")).collect()
    got = {r.stars: (r.t, r.b, r.r) for r in rows}
    assert got[1.0] == (1.0, 0.0, 1.0)
    assert got[2.5] == (1.0, 0.0, 2.5)
    assert got[3.0] == (2.0, 0.0, 3.0)
    assert got[4.0] == (3.0, 1.0, 4.0)
    assert got[5.0] == (3.0, 1.0, 5.0)
    assert got[None] == (None, None, None)   # never a class


def test_with_label_rejects_unknown_mode(spark):
    df = spark.createDataFrame([(1.0,)], "stars double")
    try:
        with_label(df, "five")
    except ValueError:
        return
    raise AssertionError("unknown mode accepted")


def test_key_split_disjoint_complete_and_partition_independent(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    train, test = split_by_key(df, "k")
    a = {r.k for r in train.collect()}
    b = {r.k for r in test.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 0.77 < len(a) / 5000 < 0.83
    train2, _ = split_by_key(df.repartition(3), "k")
    assert {r.k for r in train2.collect()} == a


def test_random_split_disjoint_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = random_split(df)
    a = {r.k for r in train.collect()}
    b = {r.k for r in test.collect()}
    assert not (a & b) and len(a | b) == 2000
    assert 0.75 < len(a) / 2000 < 0.85
