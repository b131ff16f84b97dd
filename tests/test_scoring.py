"""Scoring runner (E1, E2), head training (E8) and NumPy augmentations."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from imagelake.operators.augment import (affine, augment_dataset, hsv_shift, hsv_shift_array, rgb_to_hsv,
                                         hsv_to_rgb)
from imagelake.operators.scoring import dense_spec, extract_features, rule_mlp, score_batch
from imagelake.operators.training import head_predictions, train_head


def _features(spark, n=200, d=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(n)], "item_id long, features array<double>")
    return x, df


def test_score_batch_equals_numpy(spark):
    x, df = _features(spark)
    rng = np.random.default_rng(3)
    w1, w2 = rng.normal(size=(12, 8)), rng.normal(size=(8, 5))
    spec = dense_spec("t", [(w1, np.zeros(8), "relu"), (w2, np.ones(5), "softmax")])
    got = sorted((r.item_id, r.class_id, r.confidence, r.probs) for r in score_batch(df, spec, keep=["item_id"]).collect())
    h = np.maximum(x @ w1, 0) @ w2 + 1
    p = np.exp(h - h.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    for item, cls, conf, probs in got:
        assert cls == int(p[item].argmax())
        assert conf == pytest.approx(p[item].max(), abs=1e-12)
        assert np.allclose(probs, p[item], atol=1e-12)


def test_scaling_mismatch_is_refused(spark):
    _, df = _features(spark, n=4)
    spec = dense_spec("t", [(np.eye(12), np.zeros(12), "softmax")], scaling="signed")
    with pytest.raises(ValueError):
        score_batch(df, spec, input_scaling="unit")


def test_first_maximum_wins(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0, 0.0])], "item_id long, features array<double>")
    spec = dense_spec("tie", [(np.zeros((3, 3)), np.zeros(3), "softmax")])
    r = score_batch(df, spec, keep=["item_id"]).first()
    assert r.class_id == 0 and r.confidence == pytest.approx(1 / 3)


def test_extract_features_is_hidden_layer(spark):
    x, df = _features(spark, d=64)
    spec = rule_mlp(64, 16, 15)
    got = {r.item_id: np.array(r.feats) for r in
           extract_features(df, spec, upto=1, features_col="features", out_col="feats", keep=["item_id"]).collect()}
    w1 = spec.layers[0][0]
    want = np.maximum(x @ w1, 0).astype(np.float32)
    for i, v in got.items():
        assert np.allclose(v, want[i], atol=1e-5)


def test_head_parameter_count_of_reference_layers():
    spec = dense_spec("head", [(np.zeros((1280, 128)), np.zeros(128), "relu"),
                               (np.zeros((128, 128)), np.zeros(128), "relu"),
                               (np.zeros((128, 15)), np.zeros(15), "softmax")])
    assert sum(w.size + b.size for w, b, _ in spec.layers) == 182_415


def test_train_head_beats_majority(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(scale=4.0, size=(3, 6))
    rows = []
    for i in range(300):
        k = i % 3
        rows.append((i, [float(v) for v in centers[k] + rng.normal(size=6)], k))
    df = spark.createDataFrame(rows, "item_id long, features array<double>, label int")
    model, x = train_head(df, hidden=(16, 16), n_classes=3, max_iter=60)
    pred = head_predictions(model, x, ["item_id", "label"])
    acc = pred.select(F.avg((F.col("label") == F.col("y_pred")).cast("double"))).first()[0]
    assert acc > 0.9  # majority class is 1/3


def _pics(spark, imgs):
    rows = [(i, int(a.shape[0]), int(a.shape[1]), int(a.shape[2]), [float(v) for v in a.ravel()])
            for i, a in enumerate(imgs)]
    return spark.createDataFrame(rows, "vec_id long, height int, width int, n_channels int, pixels array<double>")


def test_affine_identity_and_quarter_turns(spark):
    rng = np.random.default_rng(5)
    img = rng.integers(0, 255, (5, 5, 3)).astype(float)
    df = _pics(spark, [img]).withColumn("angle", F.lit(0.0))
    same = np.array(affine(df).first().pixels).reshape(5, 5, 3)
    assert np.array_equal(same, img)
    turned = _pics(spark, [img]).withColumn("angle", F.lit(90.0))
    once = np.array(affine(turned).first().pixels).reshape(5, 5, 3)
    assert any(np.array_equal(once, np.rot90(img, k)) for k in (1, 3))
    four = turned
    for _ in range(4):
        four = affine(four)
    assert np.array_equal(np.array(four.first().pixels).reshape(5, 5, 3), img)


def test_hsv_zero_shift_is_identity_and_roundtrip(spark):
    rng = np.random.default_rng(6)
    img = rng.integers(0, 255, (4, 4, 3)).astype(float)
    assert np.array_equal(hsv_shift_array(img, 0, 0, 0), img)
    assert np.allclose(hsv_to_rgb(rgb_to_hsv(img)), img, atol=1e-9)
    df = _pics(spark, [img]).select("*", F.lit(360.0).alias("hue"), F.lit(0.0).alias("sat"), F.lit(0.0).alias("val"))
    assert np.allclose(np.array(hsv_shift(df).first().pixels).reshape(4, 4, 3), img, atol=1e-9)


def test_augment_dataset_is_repeatable(spark):
    rng = np.random.default_rng(7)
    imgs = [rng.integers(0, 255, (4, 4, 3)).astype(float) for _ in range(6)]
    df = _pics(spark, imgs).withColumn("split", F.when(F.col("vec_id") < 4, "train").otherwise("test"))
    a = augment_dataset(df, n=3, seed=11)
    b = augment_dataset(df, n=3, seed=11)
    ra = sorted((r.vec_id, r.variant, tuple(r.pixels)) for r in a.collect())
    rb = sorted((r.vec_id, r.variant, tuple(r.pixels)) for r in b.collect())
    assert len(ra) == 12 and ra == rb
    assert all(0 <= v <= 255 for _, _, px in ra for v in px)


def test_sql_and_numpy_picture_engines_agree(spark):
    from sf_dirs import SF_SMALL
    from imagelake import fixtures as fx
    from imagelake.operators.resize import prepare_pictures, resize_bilinear_array
    both = (fx.pix3(spark, SF_SMALL).withColumn("src", F.lit(3))
            .unionByName(fx.pix8(spark, SF_SMALL).withColumn("src", F.lit(8))))
    steps = ["to_rgb", "resize", "flip", "standardize"]
    a = {(r.vec_id, r.src): (r.height, r.width, r.n_channels, tuple(r.pixels)) for r in
         prepare_pictures(both, steps, (5, 7), engine="sql").collect()}
    b = {(r.vec_id, r.src): (r.height, r.width, r.n_channels, tuple(r.pixels)) for r in
         prepare_pictures(both, steps, (5, 7), engine="numpy").collect()}
    assert len(a) == 2 * fx.pix8(spark, SF_SMALL).count()
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][:3] == b[k][:3] == (5, 7, 3)
        assert np.allclose(a[k][3], b[k][3], rtol=0, atol=1e-12)
    img = np.arange(16, dtype=float).reshape(4, 4, 1)
    assert np.allclose(resize_bilinear_array(img, 4, 4), img)
    assert resize_bilinear_array(img, 8, 8).shape == (8, 8, 1)


def test_generator_params_in_range_and_warp_runs(spark):
    from imagelake.operators.augment import generator_augment, generator_params
    rng = np.random.default_rng(8)
    imgs = [rng.integers(0, 255, (6, 6, 3)).astype(float) for _ in range(10)]
    df = _pics(spark, imgs).withColumn("split", F.lit("train"))
    p = generator_params(df, n=4, seed=2).collect()
    assert len(p) == 40
    assert all(-30 <= r.angle <= 30 and -0.2 <= r.shift_x <= 0.2 and -0.2 <= r.shift_y <= 0.2
               and 0.85 <= r.zoom_x <= 1.15 and 0.85 <= r.zoom_y <= 1.15 and -0.15 <= r.shear <= 0.15 for r in p)
    out = generator_augment(df, n=4, seed=2).collect()
    assert len(out) == 40 and all(len(r.pixels) == 108 for r in out)
    again = sorted((r.vec_id, r.variant, tuple(r.pixels)) for r in generator_augment(df, n=4, seed=2).collect())
    assert again == sorted((r.vec_id, r.variant, tuple(r.pixels)) for r in out)


def test_exact_sums_add_inputs_in_order(spark):
    x, df = _features(spark, n=20, d=12)
    rng = np.random.default_rng(12)
    w = rng.normal(size=(12, 4))
    exact = dense_spec("e", [(w, np.zeros(4), "linear")], exact_sums=True)
    blas = dense_spec("b", [(w, np.zeros(4), "linear")])
    got = {r.item_id: r.probs for r in score_batch(df, exact, keep=["item_id"]).collect()}
    for i, probs in got.items():
        want = []
        for k in range(4):
            acc = 0.0
            for j in range(12):
                acc = acc + x[i, j] * w[j, k]
            want.append(acc)
        assert list(probs) == want
    near = {r.item_id: r.probs for r in score_batch(df, blas, keep=["item_id"]).collect()}
    assert all(np.allclose(near[i], got[i], atol=1e-12) for i in got)


def test_stacked_transforms_equal_single_picture_ones():
    from imagelake.operators.augment import affine_matrix, hsv_shift_batch, warp, warp_batch
    rng = np.random.default_rng(21)
    imgs = rng.integers(0, 255, (5, 7, 6, 3)).astype(float)
    mats = np.stack([affine_matrix(a, 0.1, -0.1, 1.1, 0.9, 5.0, 7, 6) for a in (0, 15, -30, 90, 7)])
    got = warp_batch(imgs, mats)
    for k in range(5):
        assert np.array_equal(got[k], warp(imgs[k], mats[k]))
    dh, ds, dv = np.array([0, 10, -5, 0, 3.0]), np.array([0, 5, 0, -20, 2.0]), np.array([0, 0, 8, 3, -1.0])
    hs = hsv_shift_batch(imgs, dh, ds, dv)
    for k in range(5):
        assert np.allclose(hs[k], hsv_shift_array(imgs[k], dh[k], ds[k], dv[k]), atol=1e-9)


def test_numpy_picture_steps_on_stacks_equal_single_pictures():
    from imagelake.operators.resize import _np_step
    rng = np.random.default_rng(31)
    imgs = rng.integers(0, 255, (4, 5, 6, 3)).astype(float)
    for step, size, bil in [("to_rgb", None, False), ("resize", (3, 7), False), ("resize", (7, 4), True),
                            ("flip", None, False), ("standardize", None, False), ("scale_signed", None, False)]:
        batch = _np_step(imgs, step, size, bil)
        for k in range(4):
            assert np.array_equal(batch[k], _np_step(imgs[k], step, size, bil)), step
