"""Landing, fetching and the compacted log: retries, newest pictures, odd URLs, filters in the plan."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from imagelake.dims import class_dim
from imagelake.functions.keyfilter import key_filter
from imagelake.operators.scoring import rule_head
from imagelake.sinks.compaction import _write_manifest, compact_log, newest_manifest, read_log
from imagelake.sinks.predictions import predictions_sink
from imagelake.sinks.uploads import content_id, land_uploads, write_uploads
from imagelake.sources.fetch import fetch_pixels, landed_for, newest_landed, predictions_scan
from imagelake.streaming.scoring import KEY, score_requests

BASE = "https://store.example"


def pictures(spark, rows):
    """rows (session, file, time, width, pixel value) of 4 x width x 3 pictures."""
    rows = [(s, f, t, 4, w, 3, [float(v)] * (12 * max(w, 1))) for s, f, t, w, v in rows]
    df = spark.createDataFrame(rows, "session_id string, filename string, uploaded_at string, height int, width int, n_channels int, "
                                     "pixels array<double>")
    return land_uploads(df.withColumn("uploaded_at", F.to_timestamp("uploaded_at")), BASE)


def requests(spark, urls):
    return spark.createDataFrame([(f"s{i}", f"f{i}", u, None, False) for i, u in enumerate(urls)],
                                 "session_id string, filename string, image_url string, received_at timestamp, is_malformed boolean")


def test_a_retried_landing_leaves_equal_rows(spark, scratch):
    root = os.path.join(scratch, "landing")
    one = pictures(spark, [("s", "a.jpg", "2024-01-01 10:00:00", 4, 1), ("s", "b.jpg", "2024-01-02 10:00:00", 4, 2)])
    two = pictures(spark, [("s", "a.jpg", "2024-01-01 11:00:00", 4, 3)])
    for batch in (one, two, one.repartition(3), two):  # each batch is landed again
        write_uploads(batch, root)
    got = spark.read.parquet(root)
    assert got.count() == 3
    assert sorted(r.pixels[0] for r in got.collect()) == [1.0, 2.0, 3.0]
    assert content_id(one) == content_id(one.orderBy("filename")) != content_id(two)


def test_newest_picture_counts_and_odd_urls_prune_nothing_away(spark, scratch):
    root = os.path.join(scratch, "landing")
    write_uploads(pictures(spark, [("s", "a.jpg", "2024-01-01 10:00:00", 3, 9), ("s", "b.jpg", "2024-01-03 10:00:00", 4, 50),
                                   ("s", "c.jpg", "2024-01-03 10:00:00", 3, 9)]), root)
    write_uploads(pictures(spark, [("s", "a.jpg", "2024-01-01 12:00:00", 4, 200)]), root)
    url = lambda d, f: f"{BASE}/uploads/{d}/s/{f}"
    reqs = requests(spark, [url("20240101", "a.jpg"), url("20240101", "a.jpg"), url("20240103", "b.jpg"), url("20240103", "c.jpg"),
                            url("20240103", "d.jpg"), "https://odd.example/x.jpg", None])
    landed = spark.read.parquet(root)
    out = {r.session_id: r for r in score_requests(reqs, landed, rule_head(48, 15), class_dim(spark), (4, 4, 3)).collect()}
    assert len(out) == 7
    assert [out[f"s{i}"].error for i in range(7)] == [None, None, None, "bad shape", "not found", "not found", "not found"]
    assert out["s0"].fruit == out["s1"].fruit is not None
    alone = requests(spark, [url("20240101", "a.jpg")])
    newest = landed.where("uploaded_at = timestamp'2024-01-01 12:00:00'")
    assert score_requests(alone, newest, rule_head(48, 15), class_dim(spark), (4, 4, 3)).first().confidence == out["s0"].confidence
    keys = spark.createDataFrame([("20240103", "x"), (None, None)], "upload_date string, object_key string")
    plan = landed_for(keys, landed)._jdf.queryExecution().executedPlan().toString()
    assert "20240103" in plan.split("PartitionFilters")[1].split("]")[0] and "20240101" not in plan


def test_other_pictures_are_filtered_before_the_shuffle(spark, scratch):
    root = os.path.join(scratch, "landing")
    write_uploads(pictures(spark, [("s", f"f{i}.jpg", "2024-01-01 10:00:00", 4, i) for i in range(50)]), root)
    landed = spark.read.parquet(root).withColumn("upload_date", F.col("upload_date").cast("string"))
    keys = spark.createDataFrame([("20240101", "uploads/20240101/s/f3.jpg")], "upload_date string, object_key string")
    assert key_filter(landed, keys, KEY).count() == 1
    found = newest_landed(landed, keys, KEY, ["height", "width", "n_channels"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "pixels" not in plan and "LeftSemi" in plan
    pixels = fetch_pixels(landed, found, KEY)
    assert [r.pixels[0] for r in pixels.collect()] == [3.0]
    lines = pixels._jdf.queryExecution().sparkPlan().toString().splitlines()
    scan = max(i for i, line in enumerate(lines) if "Scan" in line and "pixels" in line)
    # the nearest join above the scan of pixels is the broadcast filter
    above = [line for line in lines[:scan] if "Join" in line]
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in above)


def test_compacted_log_has_each_row_once(spark, scratch):
    log = spark.createDataFrame([(f"s{i % 3}", f"f{i}", "u", "apple", 0.5, None) for i in range(60)],
                                "session_id string, filename string, image_url string, fruit string, confidence double, error string")
    log = log.withColumn("received_at", F.current_timestamp()).withColumn("processed_at", F.current_timestamp())
    target = os.path.join(scratch, "log")
    sink = predictions_sink(target)
    part = lambda k: log.where(F.substring("filename", 2, 9).cast("int") % 6 == k)
    names = lambda df: sorted(r.filename for r in df.collect())
    for k in range(4):
        sink(part(k), k)
    before = names(read_log(spark, target))
    assert len(before) == 40 and newest_manifest(spark, target)["version"] == 0
    first = compact_log(spark, target)
    assert (first["version"], first["upto"]) == (1, 2)
    assert names(read_log(spark, target)) == before
    sink(part(3), 3)  # the last batch is replayed after the compaction
    sink(part(4), 4)
    sink(part(5), 5)
    assert len(names(read_log(spark, target))) == 60
    second = compact_log(spark, target, keep_newest=0)
    assert (second["version"], second["upto"], len(second["folders"])) == (2, 5, 2)
    assert len(set(names(read_log(spark, target)))) == len(names(read_log(spark, target))) == 60
    assert compact_log(spark, target, keep_newest=0) == second
    assert predictions_scan(spark, target, session_id="s1").count() == 20
    with pytest.raises(RuntimeError):  # a second writer of one version
        _write_manifest(spark, target, {**second, "folders": []})
    assert newest_manifest(spark, target) == second
