"""Streams equal their batch forms: scoring (E6 with B3-B5), completeness
and sampled inference (E7); a replayed batch does not duplicate rows."""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from imagelake import fixtures as fx
from imagelake.dims import class_dim
from imagelake.operators.frames import sampled_inference
from imagelake.operators.scoring import rule_head
from imagelake.operators.sessions import request_completeness
from imagelake.sinks.predictions import predictions_sink
from imagelake.sinks.uploads import land_uploads, write_uploads
from imagelake.sources.messages import REQUEST_SCHEMA, parse_messages, type_messages
from imagelake.streaming.completeness import completeness_stream, start_completeness
from imagelake.streaming.frames import sampled_inference_stream
from imagelake.streaming.scoring import ScoringJob, score_requests, start_scoring

BASE = "https://store.example"


def _landing(spark, scratch, n=24):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        day = "2024-01-0%d 10:00:00" % (1 + i % 3)
        rows.append((f"s{i % 5}", f"f{i}.jpg", day, 4, 4, 3, [float(x) for x in rng.integers(0, 255, 48)]))
    df = spark.createDataFrame(rows, "session_id string, filename string, uploaded_at string, height int, "
                                     "width int, n_channels int, pixels array<double>")
    df = land_uploads(df.withColumn("uploaded_at", F.to_timestamp("uploaded_at")), BASE)
    landing = os.path.join(scratch, "landing")
    write_uploads(df.where(F.col("filename") != "f7.jpg"), landing)  # f7 never lands
    return df, landing


def _requests(df, scratch, n_files=4):
    src = os.path.join(scratch, "requests")
    os.makedirs(src)
    rows = df.select("image_url", "session_id", "filename",
                     F.date_format("uploaded_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")).collect()
    for k in range(n_files):
        with open(os.path.join(src, f"part-{k}.json"), "w") as f:
            for r in rows[k::n_files]:
                f.write(json.dumps(r.asDict()) + "\n")
        os.utime(os.path.join(src, f"part-{k}.json"), (1_700_000_000 + k, 1_700_000_000 + k))
    with open(os.path.join(src, "part-9.json"), "w") as f:
        f.write("{not json\n")
    return src


def test_stream_scoring_equals_batch(spark, scratch):
    df, landing = _landing(spark, scratch)
    src = _requests(df, scratch)
    spec = rule_head(48, 15)
    job = ScoringJob(source_options={"path": src}, landing_root=landing,
                     target=os.path.join(scratch, "log"), errors_target=os.path.join(scratch, "errors"),
                     checkpoint=os.path.join(scratch, "ckpt"), spec=spec, shape=(4, 4, 3),
                     source_format="text", max_per_trigger=1)
    q = start_scoring(spark, job, class_dim(spark))
    q.awaitTermination(300)
    assert q.exception() is None
    log = spark.read.parquet(job.target)
    errors = spark.read.parquet(job.errors_target)
    # one row per request: scored, not landed, malformed
    assert log.count() == 23
    assert {(r.error, r.filename) for r in errors.collect()} == {("not found", "f7.jpg"), ("malformed message", None)}
    assert log.select("batch_id").distinct().count() > 1

    reqs = type_messages(parse_messages(spark.read.schema("value string").text(src)))
    batch = score_requests(reqs, spark.read.parquet(landing), spec, class_dim(spark), (4, 4, 3))
    want = {(r.filename, r.fruit, round(r.confidence, 12)) for r in batch.where("error IS NULL").collect()}
    got = {(r.filename, r.fruit, round(r.confidence, 12)) for r in log.collect()}
    assert got == want


def test_replayed_batch_is_not_duplicated(spark, scratch):
    log = fx.pred_log(spark, SF_SMALL).limit(50).select(
        "session_id", "filename", F.lit("u").alias("image_url"), F.lit("apple").alias("fruit"),
        "confidence", "received_at", "processed_at", F.lit(None).cast("string").alias("error"))
    target = os.path.join(scratch, "log")
    sink = predictions_sink(target)
    sink(log, 3)
    sink(log, 3)  # replay of the same micro-batch after a failure
    out = spark.read.parquet(target)
    assert out.count() == 50
    assert out.select("id").distinct().count() == 50


def _write_stream_files(df, folder, day_col, days):
    for d in days:
        df.where(F.dayofmonth(day_col) == d).coalesce(1).write.mode("append").parquet(folder)


def test_completeness_stream_equals_batch(spark, scratch):
    log = fx.pred_log(spark, SF_SMALL)
    req = log.select(F.col("event_id").alias("request_id"), "session_id", "received_at")
    res = log.select(F.col("event_id").alias("request_id"), "processed_at",
                     F.when(F.col("is_error"), F.lit("bad image")).alias("error"))
    rq, rs = os.path.join(scratch, "req"), os.path.join(scratch, "res")
    days = range(1, 31)
    _write_stream_files(req, rq, "received_at", days)
    _write_stream_files(res, rs, "processed_at", days)
    rq_s = spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 5).parquet(rq)
    rs_s = spark.readStream.schema(res.schema).option("maxFilesPerTrigger", 5).parquet(rs)
    q = (completeness_stream(rq_s, rs_s).writeStream.format("memory").queryName("g7_stream")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {(r.request_id, r.status) for r in spark.table("g7_stream").collect()}
    want = {(r.request_id, r.status) for r in request_completeness(req, res).collect()}
    assert got and got <= want
    # every request older than the last watermark has been emitted
    last = req.agg(F.max("received_at")).first()[0]
    old = {(r.request_id, r.status) for r in request_completeness(req, res)
           .where(F.col("received_at") < F.lit(last) - F.expr("INTERVAL 1 DAY")).collect()}
    assert old <= got


def test_sampled_inference_stream_equals_batch(spark, scratch):
    from imagelake.streaming.frames import ROCKSDB_PROVIDER, use_rocksdb_state
    assert use_rocksdb_state(spark) == ROCKSDB_PROVIDER
    frames = fx.frames(spark, SF_SMALL)
    folder = os.path.join(scratch, "frames")
    _write_stream_files(frames, folder, "ts", range(1, 31))
    stream = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 3).parquet(folder)
    ten_years = 10 * 366 * 86400  # a camera of this fixture sends a frame every few hours
    q = (sampled_inference_stream(stream, 3, idle_s=ten_years).writeStream.format("memory").queryName("e7_stream")
         .outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    cols = ["stream_id", "frame_no", "source_frame", "y_pred", "confidence", "is_error", "scored"]
    got = {tuple(r) for r in spark.table("e7_stream").select(*cols).collect()}
    want = {tuple(r) for r in sampled_inference(frames, 3).select(*cols).collect()}
    assert got == want


def test_request_schema_is_four_strings():
    assert [f.name for f in REQUEST_SCHEMA.fields] == ["image_url", "session_id", "filename", "timestamp"]


def test_scoring_stream_restarts_from_checkpoint(spark, scratch):
    df, landing = _landing(spark, scratch)
    rows = df.select("image_url", "session_id", "filename",
                     F.date_format("uploaded_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")).collect()
    src = os.path.join(scratch, "requests")
    os.makedirs(src)

    def deliver(k, part):
        with open(os.path.join(src, f"part-{k}.json"), "w") as f:
            for r in part:
                f.write(json.dumps(r.asDict()) + "\n")

    deliver(0, rows[:8])
    deliver(1, rows[8:12])
    job = ScoringJob(source_options={"path": src}, landing_root=landing,
                     target=os.path.join(scratch, "log"), errors_target=os.path.join(scratch, "errors"),
                     checkpoint=os.path.join(scratch, "ckpt"), spec=rule_head(48, 15), shape=(4, 4, 3),
                     source_format="text", max_per_trigger=1)
    q = start_scoring(spark, job, class_dim(spark))
    q.awaitTermination(300)
    assert q.exception() is None
    first = spark.read.parquet(job.target).count() + spark.read.parquet(job.errors_target).count()
    deliver(2, rows[12:20])  # later requests arrive while the job is down
    deliver(3, rows[20:])
    q = start_scoring(spark, job, class_dim(spark))
    q.awaitTermination(300)
    assert q.exception() is None
    log = spark.read.parquet(job.target)
    errors = spark.read.parquet(job.errors_target)
    assert first == 12
    assert log.count() + errors.count() == 24
    assert log.select("id").distinct().count() == log.count()


def test_completeness_file_sink_and_session_rollup(spark, scratch):
    from imagelake.operators.sessions import session_completeness
    log = fx.pred_log(spark, SF_SMALL)
    req = log.select(F.col("event_id").alias("request_id"), "session_id", "received_at")
    res = log.select(F.col("event_id").alias("request_id"), "processed_at",
                     F.when(F.col("is_error"), F.lit("bad image")).alias("error"))
    rq, rs = os.path.join(scratch, "req"), os.path.join(scratch, "res")
    _write_stream_files(req, rq, "received_at", range(1, 31))
    _write_stream_files(res, rs, "processed_at", range(1, 31))
    q = start_completeness(spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 10).parquet(rq),
                           spark.readStream.schema(res.schema).option("maxFilesPerTrigger", 10).parquet(rs),
                           os.path.join(scratch, "status"), os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    status = spark.read.parquet(os.path.join(scratch, "status"))
    assert status.count() == status.select("request_id").distinct().count() > 0
    per_session = session_completeness(status)
    assert per_session.where("n_requests != n_done + n_error + n_timed_out").count() == 0


def test_frame_stream_carries_the_last_result_seen(spark, scratch):
    from datetime import datetime
    rows = lambda frames: [("camA", f, datetime(2024, 1, 1, 0, 0, f), f % 15, 0.5 + f / 100, False)
                           for f in frames]
    schema = "stream_id string, frame_no long, ts timestamp, y_pred int, confidence double, is_error boolean"
    folder = os.path.join(scratch, "frames")
    for k, frames in enumerate([[0, 1, 2, 4, 5], [3, 6]]):  # 4 and 5 arrive before frame 3
        spark.createDataFrame(rows(frames), schema).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            if f.endswith(".parquet") and k == 0:
                os.utime(os.path.join(folder, f), (1_700_000_000, 1_700_000_000))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    q = (sampled_inference_stream(stream, 3).writeStream.format("memory").queryName("e7_late")
         .outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.frame_no: (r.source_frame, r.y_pred) for r in spark.table("e7_late").collect()}
    assert got[1] == (0, 0) and got[2] == (0, 0) and got[3] == (3, 3)
    assert got[4] == (0, 0) and got[5] == (0, 0)   # scored frame 3 not seen yet: the last result stays
    assert got[6] == (6, 6)


def test_an_idle_camera_is_forgotten(spark, scratch):
    from datetime import datetime, timedelta
    start = datetime(2024, 1, 1)
    schema = "stream_id string, frame_no long, ts timestamp, y_pred int, confidence double, is_error boolean"
    folder = os.path.join(scratch, "frames")
    # camera a is silent for two hours, camera b sends on; a frame without a counter has no result
    parts = [[("a", 0, 0), ("a", 1, 1), ("b", 0, 1), ("b", None, 2)], [("b", k, 600 * k) for k in range(1, 12)],
             [("b", 12, 7200), ("a", 2, 7201)], [("a", 3, 7202), ("a", 4, 7203), ("b", 13, 7204)]]
    for k, part in enumerate(parts):
        rows = [(c, f, start + timedelta(seconds=t), 7 if f is None else f, 0.5, False) for c, f, t in part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            path = os.path.join(folder, f)
            if f.endswith(".parquet") and os.path.getmtime(path) > 1_700_001_000:
                os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    q = (sampled_inference_stream(stream, 3, idle_s=3600, delay="1 minute").writeStream.format("memory").queryName("e7_idle")
         .outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    got = {(r.stream_id, r.frame_no): r.source_frame for r in spark.table("e7_idle").collect()}
    assert got["a", 1] == 0 and got["b", 11] == 9 and got["b", 13] == 12 and got["b", None] is None
    assert got["a", 2] is None            # frame 0 is forgotten
    assert got["a", 3] == 3 and got["a", 4] == 3


def test_several_results_in_time_give_one_row(spark, scratch):
    from datetime import datetime, timedelta
    t = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    req = spark.createDataFrame([(1, "s", t(0)), (2, "s", t(5)), (3, "s", t(6)), (9, "s", t(4000))],
                                "request_id long, session_id string, received_at timestamp")
    res = spark.createDataFrame([(1, t(20), "bad image"), (1, t(10), None), (1, t(30), None), (2, t(80), None), (2, t(5), "bad image"),
                                 (2, t(5), None), (9, t(4001), None)], "request_id long, processed_at timestamp, error string")
    rq, rs = os.path.join(scratch, "req"), os.path.join(scratch, "res")
    req.coalesce(1).write.parquet(rq)
    res.coalesce(1).write.parquet(rs)
    q = (completeness_stream(spark.readStream.schema(req.schema).parquet(rq), spark.readStream.schema(res.schema).parquet(rs))
         .writeStream.format("memory").queryName("g7_once").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(map(tuple, spark.table("g7_once").collect()))
    want = sorted(map(tuple, request_completeness(req, res).select("request_id", "session_id", "received_at", "processed_at",
                                                                   "error", "status").where("request_id < 9").collect()))
    assert got == want
    assert [(r[0], r[5]) for r in got] == [(1, "done"), (2, "done"), (3, "timed out")]


def test_scoring_job_hands_its_database_to_the_sink(spark, scratch, monkeypatch):
    from imagelake.sinks import predictions
    from imagelake.streaming import scoring
    df, landing = _landing(spark, scratch, 6)
    src = _requests(df, scratch, 1)
    rows = {}

    def write(batch, jdbc, table):
        rows.setdefault((jdbc["url"], table), []).extend(batch.select("filename").collect())

    monkeypatch.setattr(predictions, "write_jdbc_idempotent", write)
    job = ScoringJob(source_options={"path": src}, landing_root=landing, target=None, errors_target=None,
                     checkpoint=os.path.join(scratch, "ckpt"), spec=rule_head(48, 15), shape=(4, 4, 3), source_format="text",
                     jdbc={"url": "jdbc:test"}, table="p", errors_table="e")
    q = scoring.start_scoring(spark, job, class_dim(spark))
    q.awaitTermination(300)
    assert q.exception() is None
    assert len(rows["jdbc:test", "p"]) == 6 and [r.filename for r in rows["jdbc:test", "e"]] == [None]
