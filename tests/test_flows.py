"""End-to-end plans: publish uploads -> scoring stream -> log and
folder evaluation -> report (SURVEY 3.3)."""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from imagelake import fixtures as fx
from imagelake.dims import class_dim
from imagelake.operators.scoring import rule_head
from imagelake.plans.evaluation import evaluate_folder
from imagelake.plans.uploads import publish_uploads, upload_requests
from imagelake.streaming.scoring import ScoringJob, start_scoring
from pictures import write_png


def test_publish_then_score(spark, scratch):
    rng = np.random.default_rng(3)
    up = os.path.join(scratch, "incoming")
    for s, n in (("sessA", 3), ("sessB", 11)):  # sessB exceeds the 10-file cap
        os.makedirs(os.path.join(up, s))
        for i in range(n):
            write_png(os.path.join(up, s, f"p{i}.png"), rng.integers(0, 255, (4, 4, 3)))
    with open(os.path.join(up, "sessA", "notes.gif"), "wb") as f:
        f.write(b"GIF89a")
    landing, msgs = os.path.join(scratch, "landing"), os.path.join(scratch, "msgs")
    accepted = publish_uploads(upload_requests(spark, up), "https://store.example", landing,
                               {"path": msgs}, message_format="text")
    assert sorted(r.filename for r in accepted.collect()) == ["p0.png", "p1.png", "p2.png"]
    job = ScoringJob(source_options={"path": msgs}, landing_root=landing,
                     target=os.path.join(scratch, "log"), errors_target=os.path.join(scratch, "err"),
                     checkpoint=os.path.join(scratch, "ck"), spec=rule_head(48, 15), shape=(4, 4, 3),
                     source_format="text")
    q = start_scoring(spark, job, class_dim(spark))
    q.awaitTermination(300)
    log = spark.read.parquet(job.target)
    assert sorted(r.filename for r in log.collect()) == ["p0.png", "p1.png", "p2.png"]
    assert log.where("session_id = 'sessA' AND fruit IS NOT NULL").count() == 3


def test_evaluate_folder_writes_report(spark, scratch):
    root = os.path.join(scratch, "dataset")
    rng = np.random.default_rng(4)
    names = ["apple", "banana", "kiwi"]
    for split in ("test",):
        for label in names + ["unknown"]:
            d = os.path.join(root, split, label)
            os.makedirs(d)
            for i in range(4):
                write_png(os.path.join(d, f"{i}.png"), rng.integers(0, 255, (6, 6, 3)))
    hist = fx.history(spark, SF_SMALL).where("run_id = 'reference'").withColumn("run_id", F.lit("r1"))
    model_file = os.path.join(scratch, "head.npz")
    np.savez(model_file, w=np.arange(6.0))
    out = evaluate_folder(spark, root, rule_head(48, 3), names, (4, 4), hist,
                          report_path=os.path.join(scratch, "report"), run_id="r1", glob="*.png",
                          config={"model_info": {"name": "head", "version": "1.0"},
                                  "training_config": {"epochs": 10, "batch_size": 32}},
                          model_path=model_file)
    acc = out["accuracy"].first()
    assert acc.total == 12  # the unknown folder is filtered out
    cm = out["confusion"].agg(F.sum("n")).first()[0]
    assert cm == 12
    lines = spark.read.text(os.path.join(scratch, "report")).collect()
    doc = json.loads(lines[0].value)
    assert doc["performance_metrics"]["test"]["predictions_total"] == 12
    assert doc["performance_metrics"]["training"]["best_epoch"] == 7
    assert set(doc["statistical_analysis"]["per_class_accuracy"]) == set(names)
    assert list(doc) == ["model_info", "dataset_info", "training_config", "data_augmentation",
                         "model_architecture", "performance_metrics", "statistical_analysis", "integrity"]
    import hashlib
    assert doc["integrity"]["checksum"] == hashlib.sha256(open(model_file, "rb").read()).hexdigest()
    assert doc["data_augmentation"]["rotation_range"] == 30.0 and doc["training_config"]["epochs"] == 10
