"""Evaluate a model on a labelled picture folder as one Spark job graph.

decode (A2) with labels from paths (A1) -> class filter (C1) -> prepare (D1-D6) -> score
(E1, E3) -> evaluation rows -> I1-I12 -> model report (I13) -> JSON (B6).

Scoring is the expensive step and every evaluation query reads its output, so
the evaluation rows are checkpointed once into the cluster's checkpoint folder
(``spark.checkpoint.dir``): lineage is cut and a lost executor does not make
the network run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import class_dim
from ..operators import evaluate as ev_ops
from ..operators.datasets import catalog_from_paths
from ..operators.report import model_report
from ..operators.resize import prepare_pictures
from ..operators.scoring import ModelSpec, score_batch
from ..operators.validate import class_filter
from ..session import checkpoint_dir
from ..sinks.reports import report_sink
from ..sources.images import image_scan


def eval_rows_from_folder(spark: SparkSession, root: str, spec: ModelSpec, class_names: list[str],
                          size: tuple[int, int], run_id: str, glob: str = "*.jpg",
                          engine: str = "numpy") -> DataFrame:
    """``eval(run_id, item_id, y_true, y_pred, confidence)`` for every decodable
    picture under ``root`` whose folder is a known class; checkpointed."""
    classes = class_dim(spark, class_names)
    # one pass over the folder: decoded pictures carry their path, hence their label (A1)
    imgs = catalog_from_paths(image_scan(spark, root, drop_invalid=True, glob=glob).select(
        "path", "height", "width", "n_channels", "pixels"))
    labelled = class_filter(imgs, classes).join(
        F.broadcast(classes.select(F.col("name").alias("label"), F.col("class_id").alias("y_true"))), "label")
    steps = ["resize"] + {"unit": ["scale_unit"], "signed": ["scale_signed"]}.get(spec.scaling, [])
    prepared = prepare_pictures(labelled, steps, size, engine=engine)
    keyed = prepared.withColumn("item_id", F.xxhash64("path"))
    scored = score_batch(keyed, spec, "pixels", keep=["item_id", "y_true"], input_scaling=spec.scaling)
    ev = scored.select(F.lit(run_id).alias("run_id"), "item_id", "y_true",
                       F.col("class_id").alias("y_pred"), "confidence")
    checkpoint_dir(spark)
    return ev.checkpoint(eager=True)


def evaluate_folder(spark: SparkSession, root: str, spec: ModelSpec, class_names: list[str],
                    size: tuple[int, int], history: DataFrame, report_path: str | None = None,
                    run_id: str = "run", glob: str = "*.jpg", config: dict | None = None,
                    model_path: str | None = None) -> dict[str, DataFrame]:
    """All evaluation outputs for one run; writes the report when ``report_path`` is given."""
    ev = eval_rows_from_folder(spark, root, spec, class_names, size, run_id, glob)
    out = {
        "eval": ev,
        "accuracy": ev_ops.accuracy(ev),
        "report": ev_ops.classification_report(ev, class_names),
        "confusion": ev_ops.confusion_matrix(ev, class_names),
        "class_accuracy": ev_ops.class_accuracy(ev, class_names),
        "confidence": ev_ops.confidence_describe(ev),
        "bands": ev_ops.confidence_bands(ev),
        "model_report": model_report(ev, history, class_names, config, model_path),
    }
    if report_path is not None:
        report_sink(out["model_report"], report_path)
    return out
