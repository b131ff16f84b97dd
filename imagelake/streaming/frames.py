"""Sampled inference over a live frame stream (E7, streaming form).

Keyed by ``stream_id`` with ``transformWithStateInPandas``. A camera's state holds its
newest ``remember`` scored results (one record in the state store); every n-th frame,
by frame counter, adds one. Every frame is emitted with the result of the last scored
frame at or before it, so frames may come late by up to ``remember`` scored frames.
Rows are taken in the chunks in which they arrive and none are kept.

A camera that sends nothing for ``idle_s`` seconds of event time is forgotten: when it comes
back, its frames have no result until one is scored. Until then a timer, set anew with
every batch of the camera, clears its state. The watermark (``delay``) drives the timers; frames older than
the watermark are late and dropped. A frame that comes before its scored frame keeps the
last result known; the batch form, ``operators.frames``, is exact for any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.frames import SAMPLE_EVERY

REMEMBER = 64
IDLE_S = 3600
DELAY = "10 minutes"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark) -> str:
    """Keep streaming state in RocksDB (off-heap, spills to local disk, checkpointed
    with the query) unless the session already names a provider; returns the
    provider in force. Must run before the query starts."""
    key = "spark.sql.streaming.stateStore.providerClass"
    explicit = {k for k, _ in spark.sparkContext.getConf().getAll()}
    if key not in explicit:
        spark.conf.set(key, ROCKSDB_PROVIDER)
    return spark.conf.get(key)


OUT_SCHEMA = T.StructType([
    T.StructField("stream_id", T.StringType()),
    T.StructField("frame_no", T.LongType()),
    T.StructField("source_frame", T.LongType()),
    T.StructField("y_pred", T.IntegerType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("is_error", T.BooleanType()),
    T.StructField("scored", T.BooleanType()),
])
#: The newest scored results, oldest first, and the time (ms) of the newest frame.
STATE_SCHEMA = T.StructType([
    T.StructField("source_frame", T.ArrayType(T.LongType())),
    T.StructField("y_pred", T.ArrayType(T.IntegerType())),
    T.StructField("confidence", T.ArrayType(T.DoubleType())),
    T.StructField("is_error", T.ArrayType(T.BooleanType())),
    T.StructField("seen", T.LongType()),
])
RESULT = [f.name for f in STATE_SCHEMA.fields][:4]


def millis(t: pd.Timestamp) -> int:
    return pd.Timestamp(t).value // 1_000_000


class LastResults(StatefulProcessor):
    """Per camera: carry the last scored result, and forget an idle camera."""

    def __init__(self, n: int, remember: int, idle_s: int):
        self.n, self.remember, self.idle_s = n, remember, idle_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", STATE_SCHEMA)

    def remembered(self, now: int | None) -> tuple[pd.DataFrame, int | None]:
        """The results kept and the time of the newest frame; none after a silence up to ``now``."""
        kept = self.recent.get() if self.recent.exists() else None
        if kept is None or (now is not None and kept[4] is not None and now - kept[4] > 1000 * self.idle_s):
            kept = ([], [], [], [], None)
        return pd.DataFrame({c: list(v) for c, v in zip(RESULT, kept)}, columns=RESULT, dtype=object), kept[4]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        recent = None
        for chunk in rows:
            times = chunk["ts"].dropna()
            if recent is None:
                recent, seen = self.remembered(millis(times.min()) if len(times) else None)
            if len(times):
                seen = max(millis(times.max()), seen or 0)
            chunk = chunk.sort_values("frame_no", kind="stable", na_position="last")
            known = chunk["frame_no"].notna().to_numpy()
            frames = chunk["frame_no"].to_numpy()[known].astype(np.int64)
            scored = np.zeros(len(chunk), bool)
            scored[known] = frames % self.n == 0
            new = chunk[scored][["frame_no", *RESULT[1:]]].set_axis(RESULT, axis=1).astype(object)
            recent = pd.concat([recent, new]).drop_duplicates("source_frame", keep="last").sort_values("source_frame")
            sources = recent["source_frame"].to_numpy().astype(np.int64)
            at = np.full(len(chunk), -1)
            at[known] = np.searchsorted(sources, frames, "right") - 1
            out = pd.DataFrame({"stream_id": chunk["stream_id"].to_numpy(), "frame_no": chunk["frame_no"].to_numpy()})
            for c in RESULT:
                values = np.append(recent[c].to_numpy(dtype=object), None)  # place -1: no result
                out[c] = values[at]
            out["scored"] = scored
            yield out.astype({"frame_no": "Int64", "source_frame": "Int64", "y_pred": "Int32", "confidence": "Float64",
                              "is_error": "boolean"})[[f.name for f in OUT_SCHEMA.fields]]
            recent = recent.tail(self.remember)
        if recent is None:
            return
        whole = lambda c, cast: [None if pd.isna(x) else cast(x) for x in recent[c]]
        self.recent.update((whole("source_frame", int), whole("y_pred", int), whole("confidence", float), whole("is_error", bool), seen))
        if seen is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(seen + 1000 * self.idle_s)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def sampled_inference_stream(frames: DataFrame, n: int = SAMPLE_EVERY, remember: int = REMEMBER, idle_s: int = IDLE_S,
                             delay: str = DELAY) -> DataFrame:
    """Streaming twin of ``operators.frames.sampled_inference``. Needs the RocksDB state store."""
    use_rocksdb_state(frames.sparkSession)
    cols = frames.select("stream_id", "frame_no", "ts", "y_pred", "confidence", "is_error").withWatermark("ts", delay)
    return cols.groupBy("stream_id").transformWithStateInPandas(
        LastResults(n, remember, idle_s), OUT_SCHEMA, "Append", "EventTime")
