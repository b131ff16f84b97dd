"""Prediction log and error log writers.

``predictions_sink`` returns a ``foreachBatch`` function. Each micro-batch is
persisted once and written by the executors - nothing is collected to the
driver - and the write is idempotent:

* files: the batch goes to ``<target>/batch_id=<n>`` in overwrite mode, so a
  replay of batch n after a failure replaces its own output; rows are sorted by
  ``session_id`` within each file (no shuffle), so Parquet row-group statistics
  let a session lookup skip most of the log;
* JDBC: rows are appended only when their deterministic ``id`` is not in the
  table yet (anti-join against the ids of the batch's time range).

Failures propagate (the batch is retried by the stream), unlike a caught and
printed error that would commit a lost batch.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# column types for a table created by the JDBC sink; URLs and messages have no limit and take the
# database's own text type
JDBC_TYPES = {"id": "VARCHAR(64)", "session_id": "VARCHAR(100)", "filename": "VARCHAR(255)", "fruit": "VARCHAR(50)"}

LOG_COLUMNS = ["id", "session_id", "filename", "image_url", "fruit", "confidence",
               "received_at", "processed_at"]
ERROR_COLUMNS = ["id", "session_id", "filename", "image_url", "error", "received_at", "processed_at"]


def prediction_id() -> F.Column:
    """Deterministic key of a request: SHA-256 of session, file, URL and request time."""
    return F.sha2(F.concat_ws("\u0001", F.col("session_id"), F.col("filename"), F.col("image_url"),
                              F.unix_micros("received_at").cast("string")), 256)


def log_rows(scored: DataFrame) -> DataFrame:
    """Valid predictions in log layout (``error`` is null)."""
    return scored.where(F.col("error").isNull()).select(
        prediction_id().alias("id"), "session_id", "filename", "image_url", "fruit",
        F.col("confidence").cast("double").alias("confidence"), "received_at",
        F.coalesce(F.col("processed_at"), F.current_timestamp()).alias("processed_at")
        if "processed_at" in scored.columns else F.current_timestamp().alias("processed_at"))


def error_rows(scored: DataFrame) -> DataFrame:
    """Failed requests in error-log layout."""
    return scored.where(F.col("error").isNotNull()).select(
        prediction_id().alias("id"), "session_id", "filename", "image_url", "error", "received_at",
        F.current_timestamp().alias("processed_at"))


def write_jdbc_idempotent(rows: DataFrame, jdbc: dict, table: str) -> None:
    """Append only rows whose ``id`` is not in ``table``, each id once; the existing
    ids are read for the batch's request-time range and for rows without a time (the
    filter is pushed to the database). Only a missing table counts as empty; any
    other failure to read it fails the batch."""
    spark = rows.sparkSession
    rows = rows.dropDuplicates(["id"])
    lo, hi = rows.agg(F.min("received_at"), F.max("received_at")).first()
    seen = F.col("received_at").isNull()
    if lo is not None:
        seen = seen | F.col("received_at").between(lo, hi)
    try:
        existing = spark.read.format("jdbc").options(**jdbc).option("dbtable", table).load().where(seen).select("id")
        fresh = rows.join(existing, "id", "left_anti")
    except Exception as e:  # noqa: BLE001 - drivers raise their own classes
        if not re.search(r"does(n't| not) exist|not found|42X05|42P01", str(e)):
            raise
        fresh = rows
    types = ", ".join(f"{c} {t}" for c, t in JDBC_TYPES.items() if c in rows.columns)
    (fresh.write.format("jdbc").options(**jdbc).option("dbtable", table)
          .option("createTableColumnTypes", types).mode("append").save())


def predictions_sink(target: str | None = None, errors_target: str | None = None,
                     jdbc: dict | None = None, table: str = "predictions",
                     errors_table: str = "prediction_errors", score=None):
    """``foreachBatch`` writer (B3, B5). ``score`` optionally turns the raw batch
    into scored rows (``error`` null for valid ones) inside the batch."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        # the raw micro-batch is read once: scoring may look at it more than once
        # (e.g. the upload dates it mentions) before the scored rows are written
        raw = batch_df.persist() if score is not None else batch_df
        scored = score(raw, batch_id) if score is not None else batch_df
        scored = scored.persist()
        try:
            ok, bad = log_rows(scored), error_rows(scored)
            if jdbc is not None:
                write_jdbc_idempotent(ok, jdbc, table)
                write_jdbc_idempotent(bad, jdbc, errors_table)
            else:
                (ok.sortWithinPartitions("session_id", "processed_at")
                   .write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}"))
                if errors_target is not None:
                    bad.write.mode("overwrite").parquet(f"{errors_target}/batch_id={batch_id}")
        finally:
            scored.unpersist()
            if raw is not batch_df:
                raw.unpersist()

    return write
