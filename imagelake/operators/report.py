"""Model report (I13): one nested document per run.

Sections: test metrics (I1), confidence statistics (I6), per-class accuracy as
a name -> value map (I4) and training summary (E10); configuration is a
parameter. All parts are per-run aggregates joined on ``run_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles_of, value_bins
from .evaluate import class_accuracy, moments
from .training import best_epoch


def report_columns(ev: DataFrame, history: DataFrame, class_names: list[str]) -> DataFrame:
    """Flat per-run columns of the report (leaf values)."""
    # test metrics (I1) and confidence statistics (I6) from one pass over the rows
    hit = (F.col("y_true") == F.col("y_pred")).cast("long")
    bins = value_bins(ev, ["run_id"], "confidence", {"rows": F.count(F.lit(1)), "hits": F.sum(hit)})
    base = moments(bins, {"predictions_total": F.sum("rows"), "predictions_correct": F.sum("hits")})
    acc = base.select(
        "run_id", (F.col("predictions_correct") / F.col("predictions_total")).alias("test_accuracy"),
        "predictions_total", "predictions_correct",
        (F.col("predictions_total") - F.col("predictions_correct")).alias("predictions_incorrect"),
        F.col("mean").alias("conf_mean"), F.round("std", 6).alias("conf_std"), F.col("min").alias("conf_min"),
        F.col("max").alias("conf_max"))
    med = quantiles_of(ev, bins, ["run_id"], "confidence", {"conf_median": 0.5})
    per = class_accuracy(ev, class_names).groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "accuracy"))).alias("per_class_accuracy"))
    # collect_list runs over one run's class rows: bounded by the class count
    train = best_epoch(history)
    return acc.join(med, "run_id", "left").join(per, "run_id").join(train, "run_id", "left")


def lit_value(v) -> F.Column:
    """A nested Python value (dict / list / scalar) as a literal column."""
    if isinstance(v, dict):
        if not v:
            return F.create_map().cast("map<string,string>")  # written as {}
        return F.struct(*[lit_value(x).alias(k) for k, x in v.items()])
    if isinstance(v, (list, tuple)):
        return F.array(*[lit_value(x) for x in v])
    return F.lit(v)


def model_report(ev: DataFrame, history: DataFrame, class_names: list[str],
                 config: dict | None = None, model_path: str | None = None) -> DataFrame:
    """``(run_id, report STRUCT)`` with the eight sections of a model report:
    model_info, dataset_info, training_config, data_augmentation,
    model_architecture, performance_metrics, statistical_analysis, integrity.
    ``config`` supplies the descriptive sections (keys ``model_info``,
    ``training_config``, ``model_architecture``, ``dataset_info`` extras and
    ``data_augmentation``; the generator recipe by default). With ``model_path``
    the integrity section carries the file's SHA-256 (C9). ``report_sink``
    writes the result as JSON."""
    from .augment import GENERATOR_RECIPE
    cfg = dict(config or {})
    flat = report_columns(ev, history, class_names)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    checksum = F.lit(None).cast("string")
    size = F.lit(None).cast("long")
    if model_path is not None:
        from ..sources.catalog import integrity_manifest
        m = integrity_manifest(flat.sparkSession, model_path).first()  # one file: one small row
        checksum, size = F.lit(m["sha256"]), F.lit(m["size_bytes"])
    info = cfg.get("model_info", {})
    dataset_extra = cfg.get("dataset_info", {})
    aug = cfg.get("data_augmentation", {**GENERATOR_RECIPE, "fill_mode": "nearest"})
    model_file = info.get("model_file", model_path.rsplit("/", 1)[-1] if model_path else None)
    return flat.select("run_id", F.struct(
        F.struct(*[lit_value(v).alias(k) for k, v in info.items()],
                 now.alias("creation_date")).alias("model_info"),
        F.struct(F.lit(len(class_names)).alias("total_classes"),
                 F.array(*[F.lit(n) for n in class_names]).alias("classes"),
                 *[lit_value(v).alias(k) for k, v in dataset_extra.items()],
                 F.col("predictions_total").alias("test_samples")).alias("dataset_info"),
        lit_value(cfg.get("training_config", {})).alias("training_config"),
        lit_value(aug).alias("data_augmentation"),
        lit_value(cfg.get("model_architecture", {})).alias("model_architecture"),
        F.struct(
            F.struct(F.col("final_accuracy"), F.col("final_loss"), F.col("best_epoch")).alias("training"),
            F.struct(F.col("final_val_accuracy").alias("final_accuracy"),
                     F.col("final_val_loss").alias("final_loss"),
                     F.col("best_val_accuracy").alias("best_accuracy")).alias("validation"),
            F.struct(F.col("test_accuracy").alias("accuracy"), F.col("conf_mean").alias("avg_confidence"),
                     "predictions_total", "predictions_correct", "predictions_incorrect").alias("test"),
        ).alias("performance_metrics"),
        F.struct(
            F.struct(F.col("conf_mean").alias("mean"), F.col("conf_median").alias("median"),
                     F.col("conf_std").alias("std"), F.col("conf_min").alias("min"),
                     F.col("conf_max").alias("max")).alias("confidence_scores"),
            F.col("per_class_accuracy")).alias("statistical_analysis"),
        F.struct(F.lit(model_file).cast("string").alias("model_file"), size.alias("model_size_bytes"),
                 now.alias("timestamp"), checksum.alias("checksum")).alias("integrity"),
    ).alias("report"))
