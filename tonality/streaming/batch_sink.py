"""Per-batch sinks with a ledger, so that a replayed micro-batch counts once.

``foreachBatch`` hands each micro-batch to a writer as an ordinary DataFrame, for
sinks that have no streaming writer. Spark replays the last batch after a
failure, with the same id and rows: a batch may be written whole and yet come again.
Two rules make that harmless:

1. a writer puts batch ``n`` into a place of its own (a folder, a key, a
   transaction) and replaces what a failed attempt left there;
2. when the writer returns, the batch is entered in the ledger, by an atomic rename
   in the query's checkpoint folder, and a batch found there is skipped.

Batch ids start at 0 for each checkpoint. The ledger therefore lives in the
checkpoint folder and holds a key of its own, which the writer gets too, so that two
queries never take each other's batches for their own. An empty batch is
entered but not written.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tonality.streaming.score_stream import DEFAULT_TRIGGER

# Called with the batch, its id and the ledger's key.
BatchWriter = Callable[[DataFrame, int, str], None]


class BatchLedger:
    """The committed batches of one streaming query, as files in a shared folder."""

    def __init__(self, spark: SparkSession, checkpoint_dir: str):
        self._jvm = spark._jvm
        self._dir = self._path(f"{checkpoint_dir.rstrip('/')}/batch-ledger")
        self._fs = self._dir.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._dir)
        self._publish("key", uuid.uuid4().hex)
        self.key: str = self._read("key")

    def _path(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def _publish(self, name: str, text: str) -> bool:
        """``name`` with its content, whole or not at all; False if it is already there."""
        final = self._path(self._dir, name)
        if self._fs.exists(final):
            return False
        part = self._path(self._dir, f"_{name}-{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        return self._fs.rename(part, final)

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._path(self._dir, name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def committed(self, batch_id: int) -> bool:
        return self._fs.exists(self._path(self._dir, f"batch-{batch_id}"))

    def commit(self, batch_id: int, **info) -> None:
        self._publish(f"batch-{batch_id}", json.dumps(info))

    def entries(self) -> dict[int, dict]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._dir)]
        return {int(n[6:]): json.loads(self._read(n)) for n in sorted(names) if n.startswith("batch-")}


def folder_writer(path: str, fmt: str = "parquet") -> BatchWriter:
    """Each batch as a folder ``query=<key>/batch=<id>`` below ``path``, replaced as a whole."""
    def write(batch: DataFrame, batch_id: int, key: str) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/query={key}/batch={batch_id}")
    return write


def start_batches(stream: DataFrame, write: BatchWriter, checkpoint_dir: str, trigger: str | None = DEFAULT_TRIGGER,
                  available_now: bool = False) -> StreamingQuery:
    """Start ``stream`` into ``write``; each batch is written and entered in the ledger once."""
    ledger = BatchLedger(stream.sparkSession, checkpoint_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        if ledger.committed(batch_id):
            return
        started = time.time()
        empty = batch.isEmpty()
        if not empty:
            write(batch, batch_id, ledger.key)
        ledger.commit(batch_id, written=not empty, start=started, end=time.time())

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=trigger or DEFAULT_TRIGGER)
    return writer.start()
