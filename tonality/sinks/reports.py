"""Run reports as one-row tables, written as JSON or parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(report: DataFrame, path: str, fmt: str = "json",
                 mode: str = "overwrite") -> None:
    report.coalesce(1).write.mode(mode).format(fmt).save(path)
