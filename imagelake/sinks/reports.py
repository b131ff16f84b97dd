"""Model report writer (B6): one JSON document per run, partitioned by run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_json(reports: DataFrame) -> DataFrame:
    """``(run_id, value)`` with the report as JSON text."""
    return reports.select("run_id", F.to_json("report").alias("value"))


def report_sink(reports: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``<path>/run_id=<run>/part-*.txt``, one JSON line per run."""
    report_json(reports).write.mode(mode).partitionBy("run_id").text(path)
