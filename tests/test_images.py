"""Real picture folders: catalogue (A1, H1), decoding (A2, D5), validation (C4)
and integrity manifest (C9)."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from imagelake.operators.datasets import folder_counts, split_stats
from imagelake.operators.validate import classify_inputs, reason_counts
from imagelake.sources.catalog import image_catalog, integrity_manifest
from imagelake.sources.images import image_scan
from pictures import write_png

RGB = np.arange(4 * 4 * 3, dtype=np.uint8).reshape(4, 4, 3) * 5


@pytest.fixture()
def tree(scratch):
    """dataset/{train,test}/{apple,banana,kiwi}/*.png plus grey, alpha and corrupt files."""
    root = os.path.join(scratch, "dataset")
    rng = np.random.default_rng(0)
    for split in ("train", "test"):
        for label in ("apple", "banana", "kiwi"):
            d = os.path.join(root, split, label)
            os.makedirs(d)
            for i in range(2):
                write_png(os.path.join(d, f"{label}_{i}.png"), rng.integers(0, 255, (4, 4, 3)))
    odd = os.path.join(root, "test", "odd")
    os.makedirs(odd)
    write_png(os.path.join(odd, "rgb.png"), RGB)
    write_png(os.path.join(odd, "grey.png"), RGB[:, :, 0])
    rgba = np.concatenate([RGB, np.full((4, 4, 1), 200, np.uint8)], axis=2)
    write_png(os.path.join(odd, "alpha.png"), rgba)
    with open(os.path.join(odd, "corrupt.png"), "wb") as f:
        f.write(b"\x89PNG not really a picture")
    return root


def test_catalog_labels_splits_and_no_content_read(spark, tree):
    cat = image_catalog(spark, tree, glob="*.png")
    rows = {(r.file_name, r.label, r.split) for r in cat.collect()}
    assert ("apple_0.png", "apple", "train") in rows
    assert ("kiwi_1.png", "kiwi", "test") in rows
    assert ("grey.png", "odd", "test") in rows
    assert len(rows) == 16
    plan = cat._jdf.queryExecution().executedPlan().toString()
    read_schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln]
    assert read_schema and all("content" not in ln for ln in read_schema)


def test_folder_counts_and_split_stats(spark, tree):
    cat = image_catalog(spark, tree, glob="*.png")
    counts = {os.path.basename(r.folder): r.n_files for r in folder_counts(cat).collect()}
    assert counts["apple"] == 2 and counts["odd"] == 4
    st = {r.split: (r.n_images, r.n_labels, r.share) for r in split_stats(cat).collect()}
    assert st["train"] == (6, 3, 6 / 16)
    assert st["test"][0] == 10


def test_image_scan_channel_orders(spark, tree):
    imgs = {os.path.basename(r.path): r for r in
            image_scan(spark, os.path.join(tree, "test", "odd")).collect()}
    rgb = imgs["rgb.png"]
    assert (rgb.height, rgb.width, rgb.n_channels) == (4, 4, 3)
    assert np.array_equal(np.array(rgb.pixels), RGB.ravel().astype(np.float32))
    grey = imgs["grey.png"]
    assert np.array_equal(np.array(grey.pixels).reshape(4, 4, 3), np.repeat(RGB[:, :, :1], 3, axis=2))
    assert np.array_equal(np.array(imgs["alpha.png"].pixels), RGB.ravel().astype(np.float32))
    bad = imgs["corrupt.png"]
    assert bad.height == -1 and bad.pixels is None


def test_image_scan_raw_is_bgr(spark, tree):
    raw = image_scan(spark, os.path.join(tree, "test", "odd"), rgb=False, glob="rgb.png").first()
    assert np.array_equal(np.array(raw.pixels).reshape(4, 4, 3), RGB[:, :, ::-1])


def test_classify_inputs_on_pictures(spark, tree):
    odd = os.path.join(tree, "test", "odd")
    imgs = image_scan(spark, odd).withColumn("object_id", F.element_at(F.split("path", "/"), -1))
    req = spark.createDataFrame([(n,) for n in ["rgb.png", "grey.png", "alpha.png", "corrupt.png", "gone.png"]],
                                "object_id string")
    got = {r.object_id: r.reason for r in classify_inputs(req, imgs, shape=(4, 4, 3)).collect()}
    assert got == {"rgb.png": "ok", "grey.png": "ok", "alpha.png": "ok",
                   "corrupt.png": "processing error", "gone.png": "not found"}
    small = {r.reason: r.n for r in reason_counts(classify_inputs(req, imgs, shape=(8, 8, 3))).collect()}
    assert small == {"ok": 0, "bad shape": 3, "processing error": 1, "not found": 1}


def test_integrity_manifest_matches_hashlib(spark, tree):
    got = {os.path.basename(r.path): (r.size_bytes, r.sha256)
           for r in integrity_manifest(spark, os.path.join(tree, "test", "odd")).collect()}
    for name in ("rgb.png", "corrupt.png"):
        data = open(os.path.join(tree, "test", "odd", name), "rb").read()
        assert got[name] == (len(data), hashlib.sha256(data).hexdigest())
