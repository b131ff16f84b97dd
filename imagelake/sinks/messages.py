"""Publish upload requests as JSON messages (B2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def message_value(df: DataFrame, ts_col: str = "uploaded_at", keep: list[str] | None = None,
                  ts_text: F.Column | None = None) -> DataFrame:
    """``value`` = JSON ``{image_url, session_id, filename, timestamp}`` with an
    ISO-8601 timestamp (or ``ts_text`` when given); ``key`` = session id (keeps a
    session on one partition of the topic, in order)."""
    ts = ts_text if ts_text is not None else F.date_format(F.col(ts_col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.select(*(keep or []), F.col("session_id").alias("key"), F.to_json(F.struct(
        "image_url", "session_id", "filename", ts.alias("timestamp"))).alias("value"))


def message_sink(df: DataFrame, options: dict, fmt: str = "kafka") -> None:
    """Write messages to a topic (``options`` holds servers and ``topic``) or, with
    ``fmt="text"``, as JSON lines under ``options["path"]``."""
    if fmt == "kafka":
        df.select("key", "value").write.format("kafka").options(**options).save()
    else:
        df.select("value").write.mode(options.get("mode", "append")).text(options["path"])
