"""Partition-size policies change the physical layout, never the rows."""

from tonality.plans.classifier import MIN_ROWS_PER_FIT_PARTITION, fit_partitions
from tonality.session import spark_parallelism, spread, table

from paths import SF_SMALL


def test_spread_raises_small_scans_only(spark):
    small = table(spark, SF_SMALL, "documents")
    assert small.rdd.getNumPartitions() < spark_parallelism(spark)
    spread_small = spread(small)
    assert spread_small.rdd.getNumPartitions() == spark_parallelism(spark)
    assert sorted(r.doc_id for r in spread_small.select("doc_id").collect()) == \
        sorted(r.doc_id for r in small.select("doc_id").collect())
    many = spark.range(0, 1000, 1, numPartitions=spark_parallelism(spark) * 2)
    assert spread(many) is many                  # enough splits: no shuffle added


def test_fit_partitions_bounds_rows_per_task(spark):
    df = spark.range(0, 50_000, 1, numPartitions=64)
    out = fit_partitions(df)
    try:
        assert out.rdd.getNumPartitions() == -(-50_000 // MIN_ROWS_PER_FIT_PARTITION)
        assert out.count() == 50_000
    finally:
        df.unpersist()
    few = spark.range(0, 100, 1, numPartitions=1)
    assert fit_partitions(few).rdd.getNumPartitions() == 1
    few.unpersist()
