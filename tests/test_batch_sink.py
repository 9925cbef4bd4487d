"""Per-batch sinks: a batch that fails at any point and comes again counts once."""

import os

import pytest
from pyspark.sql import functions as F

from tonality.plans import checks
from tonality.streaming.batch_sink import BatchLedger, folder_writer, start_batches
from tonality.streaming.score_stream import read_review_stream, with_review_key

from paths import SF_SMALL


def drop_file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("review\n" + "".join(f"{x}\n" for x in lines))


def run(spark, base, write):
    stream = read_review_stream(spark, f"{base}/in", max_files_per_trigger=1)
    start_batches(stream, write, f"{base}/ckpt", available_now=True).awaitTermination()


def rows(spark, base):
    return sorted(r.review for r in spark.read.parquet(f"{base}/out").collect())


def test_failure_after_the_write_gives_each_row_once(spark, tmpdir_fresh):
    base, calls = tmpdir_fresh, []
    for i in range(3):
        drop_file(f"{base}/in", f"f{i}", [f"r{i}-{j}" for j in range(4)])
    inner = folder_writer(f"{base}/out")

    def failing(batch, batch_id, key):
        calls.append(batch_id)
        inner(batch, batch_id, key)
        if calls.count(1) == 1 and batch_id == 1:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        run(spark, base, failing)
    assert 1 not in BatchLedger(spark, f"{base}/ckpt").entries()
    run(spark, base, failing)
    assert calls == [0, 1, 1, 2]
    assert rows(spark, base) == sorted(f"r{i}-{j}" for i in range(3) for j in range(4))
    drop_file(f"{base}/in", "later", ["new"])
    run(spark, base, failing)
    assert calls[-1] == 3 and len(rows(spark, base)) == 13


def test_failure_after_the_entry_is_not_written_again(spark, tmpdir_fresh, monkeypatch):
    """Even a sink that only appends gets the batch once, if the ledger has it."""
    base, got = tmpdir_fresh, []
    drop_file(f"{base}/in", "a", ["x", "y"])

    def append(batch, batch_id, key):
        got.extend(r.review for r in batch.collect())

    commit = BatchLedger.commit

    def commit_then_fail(self, batch_id, **info):
        commit(self, batch_id, **info)
        raise RuntimeError("lost after the entry")

    monkeypatch.setattr(BatchLedger, "commit", commit_then_fail)
    with pytest.raises(Exception, match="lost after the entry"):
        run(spark, base, append)
    monkeypatch.undo()
    run(spark, base, append)
    assert sorted(got) == ["x", "y"]


def test_ledgers_of_two_queries_do_not_mix(spark, tmpdir_fresh):
    a, again, b = (BatchLedger(spark, f"{tmpdir_fresh}/{x}") for x in "aab")
    a.commit(0, written=True)
    assert a.key == again.key != b.key
    assert again.committed(0) and not b.committed(0) and not a.committed(1)
    a.commit(0, written=False)
    assert a.entries() == {0: {"written": True}}


def test_blank_and_repeated_reviews_keep_a_key(spark, tmpdir_fresh):
    drop_file(f"{tmpdir_fresh}/in", "a", ["x", '""', "x"])
    drop_file(f"{tmpdir_fresh}/in", "b", ["x"])
    q = (with_review_key(read_review_stream(spark, f"{tmpdir_fresh}/in")).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmpdir_fresh}/c").trigger(availableNow=True).start(f"{tmpdir_fresh}/out"))
    q.awaitTermination()
    out = spark.read.parquet(f"{tmpdir_fresh}/out")
    assert out.count() == 4 and out.filter(F.col("review_key").isNull()).count() == 0
    assert out.select("review_key").distinct().count() == 3


def test_registered_query_scores_every_review_once(spark):
    got = checks.QUERIES["stream_batches"](spark, SF_SMALL)
    want = checks.QUERIES["lr_predict"](spark, SF_SMALL)
    assert got.count() == want.count()
    assert got.filter("prediction is null or review_key is null").count() == 0
