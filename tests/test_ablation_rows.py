from tonality.plans.classifier import ablation_interval

SCHEMA = "review_id long, text string, label double, vader double"


def test_ablation_interval_makes_its_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = [(i, f"{'good' if i % 2 else 'bad'} word{i % 7} text", float(i % 2), 0.5 - i % 2) for i in range(120)]
    rows += [(500, None, 1.0, 0.1), (501, "x", None, 0.1), (502, "x", 1.0, None)]
    scored = spark.createDataFrame(rows, SCHEMA).coalesce(2).mapInPandas(counted, SCHEMA)
    r = ablation_interval(scored, replicates=5, num_features=64, max_iter=2).first()
    assert made.value == len(rows)
    assert 0 < r.total < 120 and r.accuracy_a == r.accuracy_b == 1.0 and r.low == r.gain == r.high == 0.0
