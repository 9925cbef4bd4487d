import pytest
from pyspark.sql import functions as F

from tonality.operators import split
from tonality.operators.split import exact_split, kth_smallest


@pytest.mark.parametrize("n, fraction, take", [(1, 0.8, 1), (7, 0.8, 6), (1000, 0.8, 800), (999, 0.25, 250), (10, 0.0, 0), (10, 1.0, 10)])
def test_train_has_exactly_its_share(spark, n, fraction, take):
    df = spark.range(n)
    train, test = exact_split(df, "id", fraction)
    assert (train.count(), test.count()) == (take, n - take)


def test_same_rows_whatever_the_partitioning(spark):
    df = spark.range(500)
    got = [sorted(r.id for r in exact_split(d, "id")[0].collect()) for d in (df.coalesce(1), df.repartition(7, F.rand(3)))]
    assert got[0] == got[1] and len(got[0]) == 400


def test_repeated_and_null_keys_and_empty_table(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    train, test = exact_split(df, "k", 0.5)
    assert len({r.k for r in train.collect()}) == 1
    assert {r.k for r in test.collect()} >= {None}
    assert train.count() + test.count() == 5
    assert not {r.k for r in train.collect()} & {r.k for r in test.collect()}
    train, test = exact_split(df.limit(0), "k")
    assert train.count() == test.count() == 0


def test_equal_hashes_are_taken_by_key(spark, monkeypatch):
    monkeypatch.setattr(split, "key_hash", lambda key, seed=0: F.when(key.isNotNull(), F.lit(5).cast("bigint")))
    df = spark.createDataFrame([(k,) for k in "dbeac"], "k string")
    assert sorted(r.k for r in exact_split(df, "k", 0.6)[0].collect()) == ["a", "b", "c"]


def test_kth_smallest_equals_sorting(spark):
    values = [(i * 7919 ** 4) % (1 << 60) for i in range(300)] + [3, 3, 3, (1 << 60) - 1]
    h = spark.createDataFrame([(v,) for v in values], "h long")
    order = sorted(values)
    for k in (1, 2, 3, 4, 150, 304):
        assert kth_smallest(h, k) == (order[k - 1], k - order.index(order[k - 1]))
    with pytest.raises(ValueError):
        kth_smallest(h, 305)
