import hashlib

from tonality.operators.resampling import draw_thresholds, paired_interval, replicate_counts

ROWS = [(i, float(i % 2), 1.0, float(i % 3 == 1) if i % 5 else None) for i in range(400)]
SCHEMA = "key long, label double, a double, b double"


def plain(rows, replicate, seed=42):
    n = ra = rb = 0
    for key, label, a, b in rows:
        u = int(hashlib.md5(f"{seed}:{replicate}:{key}".encode()).hexdigest()[:7], 16)
        t = sum(u >= cut for cut in draw_thresholds()) if replicate else 1
        n, ra, rb = n + t, ra + t * (a == label), rb + t * (b == label)
    return n, ra, rb


def test_replicates_equal_plain_counting_whatever_the_partitioning(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for d in (df.coalesce(1), df.repartition(5)):
        got = {r.replicate: (r.n, r.right_a, r.right_b) for r in replicate_counts(d, "key", "label", "a", "b", 20, 42).collect()}
        assert got == {k: plain(ROWS, k) for k in range(21)}


def test_interval_holds_the_gain_and_narrows(spark):
    wide = []
    for n in (100, 400):
        r = paired_interval(spark.createDataFrame(ROWS[:n], SCHEMA), "key").first()
        _, ra, rb = plain(ROWS[:n], 0)
        assert (r.total, r.accuracy_a, r.accuracy_b, r.gain) == (n, ra / n, rb / n, (rb - ra) / n)
        assert r.low < r.gain < r.high
        wide.append(r.high - r.low)
    assert wide[1] < wide[0]


def test_equal_predictions_gain_nothing(spark):
    r = paired_interval(spark.createDataFrame(ROWS, SCHEMA), "key", a="a", b="a").first()
    assert (r.gain, r.low, r.high) == (0.0, 0.0, 0.0)


def test_null_keys_and_labels_and_empty_table(spark):
    some = spark.createDataFrame([(None, 1.0, 1.0, 1.0), (1, None, 1.0, 1.0)], SCHEMA)
    r = paired_interval(some, "key").first()
    assert tuple(r) == (0, None, None, None, None, None)
