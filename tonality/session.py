"""Session helpers: a local session for tests and benches, and shared scratch paths.

Library functions never create or stop sessions and never change global
configuration; they take the caller's session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "tonality", cores: str | int | None = None,
                  shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and benches (UI off, AQE on, UTC)."""
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session names none (local tests) is a private folder set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        configured = tempfile.mkdtemp(prefix="tonality-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tonality/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df, min_partitions: int | None = None):
    """Parallelism floor for a freshly read table.

    A scan with fewer splits than the session has task slots (a small file,
    one row group) would run all per-row text work in that many tasks; such
    an input is repartitioned round-robin to the slot count. A large input
    already has at least that many splits and is returned as is, so no
    shuffle is added at scale. Call it on a plain scan: counting the splits
    of a scan only lists files.
    """
    target = min_partitions or spark_parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def spark_parallelism(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def text_table(spark: SparkSession, sf_dir: str, name: str):
    """A text-bearing table (``documents``, ``conversations``) with the
    parallelism floor of ``spread``."""
    return spread(table(spark, sf_dir, name))
