"""Request completeness over streams (G7, streaming form).

A stream-stream left outer join of requests and results on the request key
with the time bound ``processed_at BETWEEN received_at AND received_at + 60 s``.
Both sides carry watermarks, so state is dropped once a request can no longer
match. An aggregate per request then keeps the first of its matches, so a request
with several results in time is one row, as in the batch form
(``operators.sessions.request_completeness``). It is emitted when the watermark
has passed the request's deadline, matched or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sessions import RESULT_TIMEOUT_S


def completeness_stream(requests: DataFrame, results: DataFrame, key: str = "request_id",
                        timeout_s: int = RESULT_TIMEOUT_S, delay: str = "2 minutes") -> DataFrame:
    """Per request: ``done`` / ``error`` when a result arrived in time, else ``timed out``.
    ``requests(key, session_id, received_at)``, ``results(key, processed_at, error)``."""
    req = requests.withWatermark("received_at", delay).alias("q")
    res = results.withColumnRenamed(key, "_rkey").withWatermark("processed_at", delay).alias("r")
    cond = ((F.col("q." + key) == F.col("r._rkey"))
            & (F.col("r.processed_at") >= F.col("q.received_at"))
            & (F.col("r.processed_at") <= F.col("q.received_at") + F.expr(f"INTERVAL {int(timeout_s)} SECONDS")))
    j = req.join(res, cond, "leftOuter").select(
        F.col("q." + key).alias(key), F.col("q.session_id").alias("session_id"), F.col("q.received_at").alias("received_at"),
        F.when(F.col("r._rkey").isNotNull(), F.struct(F.col("r.processed_at"), F.col("r.error"))).alias("_r"))
    # of results at one instant, a success comes before an error
    order = F.when(F.col("_r").isNotNull(), F.struct("_r.processed_at", F.coalesce("_r.error", F.lit(""))))
    first = j.groupBy(key, "session_id", "received_at").agg(F.min_by("_r", order).alias("_r"))
    status = (F.when(F.col("_r").isNull(), "timed out")
              .when(F.col("_r.error").isNotNull(), "error").otherwise("done"))
    return first.select(key, "session_id", "received_at", F.col("_r.processed_at").alias("processed_at"),
                        F.col("_r.error").alias("error"), status.alias("status"))


def start_completeness(requests: DataFrame, results: DataFrame, target: str, checkpoint: str,
                       available_now: bool = True, key: str = "request_id",
                       timeout_s: int = RESULT_TIMEOUT_S, delay: str = "2 minutes"):
    """Run ``completeness_stream`` into a Parquet table through Spark's file sink,
    which commits each micro-batch exactly once (its own metadata log), so a
    restart neither loses nor duplicates statuses. Per-session completeness is
    then ``operators.sessions.session_completeness`` over that table."""
    w = (completeness_stream(requests, results, key, timeout_s, delay).writeStream
         .format("parquet").option("path", target).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
