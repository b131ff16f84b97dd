"""Properties and golden values from the reference's documents."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from imagelake import fixtures as fx
from imagelake.dims import CLASS_NAMES
from imagelake.functions import tensors as D
from imagelake.functions.quantiles import exact_quantiles
from imagelake.operators import evaluate as ev_ops
from imagelake.operators.training import best_epoch, early_stop


def test_flip_twice_is_identity(spark):
    p = fx.pix3(spark, SF_SMALL)
    twice = p.select("pixels", D.flip_h(D.flip_h("pixels", "height", "width", "n_channels"),
                                        "height", "width", "n_channels").alias("back"))
    assert twice.where("pixels != back").count() == 0


def test_destandardize_inverts_standardize(spark):
    p = fx.pix3(spark, SF_SMALL).select("pixels", D.destandardize(D.standardize("pixels")).alias("back"))
    for r in p.collect():
        assert np.allclose(np.array(r.back), np.array(r.pixels) / 255.0, atol=1e-12)


def test_rgb_twice_is_identity_for_three_channels(spark):
    p = fx.pix3(spark, SF_SMALL)
    back = p.select("pixels", D.to_rgb(D.to_rgb("pixels", "height", "width", "n_channels"),
                                       "height", "width", F.lit(3)).alias("back"))
    assert back.where("pixels != back").count() == 0


def test_evaluation_identities(spark):
    ev = fx.eval_rows(spark, SF_SMALL)
    acc = {r.run_id: (r.total, r.accuracy) for r in ev_ops.accuracy(ev).collect()}
    cm = {r.run_id: r.n for r in ev_ops.confusion_matrix(ev, CLASS_NAMES).groupBy("run_id")
          .agg(F.sum("n").alias("n")).collect()}
    assert {k: v[0] for k, v in acc.items()} == cm
    rep = ev_ops.classification_report(ev, CLASS_NAMES).where("label = 'weighted avg'").collect()
    for r in rep:
        assert r.recall == pytest.approx(acc[r.run_id][1], abs=1e-9)
    bands = ev_ops.confidence_bands(ev).groupBy("run_id").agg(F.sum("n").alias("n"), F.sum("share").alias("s"))
    for r in bands.collect():
        assert r.n == acc[r.run_id][0] and r.s == pytest.approx(1.0)
    hist = ev_ops.confidence_histogram(ev).groupBy("run_id").agg(F.sum("n").alias("n"))
    assert {r.run_id: r.n for r in hist.collect()} == cm


def _golden_eval(spark):
    """137 test pictures, 133 right: apple 8/10, banana 8/9, chilli pepper 6/7, rest all right."""
    rows, item = [], 0
    supports = {0: (10, 8), 1: (9, 8), 3: (7, 6)}
    rest = [c for c in range(15) if c not in supports]
    for i, c in enumerate(rest):
        supports[c] = (9 + (3 if i == 0 else 0), 9 + (3 if i == 0 else 0))
    for c, (n, right) in sorted(supports.items()):
        for k in range(n):
            pred = c if k < right else (c + 1) % 15
            rows.append(("golden", item, c, pred, 0.99))
            item += 1
    return spark.createDataFrame(rows, "run_id string, item_id long, y_true int, y_pred int, confidence double")


def test_golden_accuracy_and_classes(spark):
    ev = _golden_eval(spark)
    a = ev_ops.accuracy(ev).first()
    assert (a.total, a.correct, a.incorrect) == (137, 133, 4)
    assert a.accuracy == pytest.approx(0.9708029197, abs=1e-10)
    bw = ev_ops.best_worst(ev, CLASS_NAMES).first()
    assert bw.mean_class_accuracy == pytest.approx(0.9697354, abs=1e-7)
    assert bw.best_class == "bell pepper" and bw.worst_class == "apple"
    tiers = {r.name: r.tier for r in ev_ops.class_accuracy(ev, CLASS_NAMES).collect()}
    assert tiers["apple"] == "red" and tiers["banana"] == "yellow" and tiers["chilli pepper"] == "yellow"
    assert sum(t == "green" for t in tiers.values()) == 12


def test_golden_history(spark):
    h = fx.history(spark, SF_SMALL).where("run_id = 'reference'")
    b = best_epoch(h).first()
    assert b.best_epoch == 7 and b.final_accuracy == 0.98 and b.final_val_accuracy == 0.97
    gap = ev_ops.overfit_gap(h).first()
    assert gap.gap == pytest.approx(0.01) and gap.verdict == "balanced"
    es = early_stop(h).first()
    assert es.stopped is False and es.last_epoch == 9 and es.best_epoch == 9


def test_early_stop_patience(spark):
    vals = [0.5, 0.4, 0.45, 0.46, 0.47, 0.3]
    h = spark.createDataFrame([("r", e, "val_loss", v) for e, v in enumerate(vals)],
                              "run_id string, epoch int, metric string, value double")
    es = early_stop(h, patience=3).first()
    assert es.stopped is True and es.last_epoch == 4 and es.best_epoch == 1


def test_exact_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(2)
    hot = rng.random(3000)
    cold = {f"k{i}": rng.random(int(rng.integers(1, 40))) for i in range(60)}
    rows = [("hot", float(v)) for v in hot] + [(k, float(v)) for k, vs in cold.items() for v in vs]
    df = spark.createDataFrame(rows, "key string, x double").repartition(7)
    got = {r.key: (r.q1, r.med, r.q3) for r in
           exact_quantiles(df, ["key"], "x", {"q1": 0.25, "med": 0.5, "q3": 0.75}).collect()}
    want = {"hot": hot, **cold}
    assert set(got) == set(want)
    for k, vs in want.items():
        assert got[k] == pytest.approx(tuple(np.percentile(vs, [25, 50, 75])), abs=1e-12)


def test_group_row_number_equals_window_with_hot_key(spark):
    from pyspark.sql import Window
    from imagelake.functions.ranks import group_row_number
    rng = np.random.default_rng(9)
    rows = [("hot", int(i)) for i in rng.permutation(5000)] + \
           [(f"k{i % 40}", int(i)) for i in range(5000, 5600)]
    df = spark.createDataFrame(rows, "key string, t long").repartition(9)
    got = {(r.key, r.t): r.row_no for r in group_row_number(df, ["key"], ["t"]).collect()}
    w = Window.partitionBy("key").orderBy("t")
    want = {(r.key, r.t): r.rn for r in df.select("key", "t", (F.row_number().over(w) - 1).alias("rn")).collect()}
    assert got == want


def test_carry_forward_over_a_missing_scored_frame(spark):
    from imagelake.operators.frames import sampled_inference
    rows = [("a", f, None, f, 0.5, False) for f in range(1, 35) if f not in (10, 20)] + [("b", 3, None, 1, 0.1, True)]
    frames = spark.createDataFrame(rows + [("a", 0, None, 0, 0.5, False)],
                                   "stream_id string, frame_no long, ts timestamp, y_pred int, confidence double, is_error boolean")
    got = {(r.stream_id, r.frame_no): (r.source_frame, r.y_pred, r.scored) for r in sampled_inference(frames, 10).collect()}
    assert got[("a", 12)] == (0, 0, False) and got[("a", 29)] == (0, 0, False)
    assert got[("a", 30)] == (30, 30, True) and got[("a", 34)] == (30, 30, False)
    assert got[("b", 3)] == (None, None, False)


def test_row_numbers_with_payload_and_hot_key(spark):
    from pyspark.sql import Window
    from imagelake.functions.ranks import group_row_number
    n = 400_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("k"),
                               F.xxhash64("id").alias("o"), "id", F.repeat(F.lit("x"), 20).alias("payload"))
    got = group_row_number(df, ["k"], ["o"])
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("o")) - 1)
    assert got.count() == n
    assert got.select("id", "row_no").join(want.select("id", "want"), "id").where("row_no <> want").count() == 0


def test_completeness_counts_only_results_in_time(spark):
    from datetime import datetime, timedelta
    from imagelake.operators.sessions import request_completeness
    t = datetime(2024, 1, 1)
    requests = spark.createDataFrame([(i, "s", t) for i in range(4)], "request_id long, session_id string, received_at timestamp")
    at = lambda s: t + timedelta(seconds=s)
    results = spark.createDataFrame(
        [(0, at(-5), "early"), (0, at(9), None), (0, at(9), "tie"), (1, at(61), None), (2, at(3), "bad"), (2, at(4), None)],
        "request_id long, processed_at timestamp, error string")
    got = {r.request_id: r.status for r in request_completeness(requests, results).collect()}
    assert got == {0: "done", 1: "timed out", 2: "error", 3: "timed out"}
