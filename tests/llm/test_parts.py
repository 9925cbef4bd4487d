"""Operator 4: parts of a node."""

import random

from tonality.llm import topk


def test_parts_do_not_depend_on_row_order(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random(), rng.random()], 2, 0) for i in range(300)]
    schema = "id long, v array<double>, dim int, node int"
    packed = lambda r, n: {(p.part, tuple(sorted(p.ids))) for p in topk._packed(
        spark.createDataFrame(r, schema).repartition(n), 50, "order").collect()}
    assert packed(rows, 1) == packed(rows[::-1], 3)
