"""Training-history operators and the classifier head.

History windows partition by run and order by epoch; a run has one row per
epoch and metric, so these windows are bounded by the epoch count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EARLY_STOP_PATIENCE = 3  # fixed value: patience on val_loss


def early_stop(history: DataFrame, patience: int = EARLY_STOP_PATIENCE,
               monitor: str = "val_loss") -> DataFrame:
    """Where early stopping on ``monitor`` (lower is better, no minimum delta)
    ends each run (E9): training stops at the first epoch with ``patience`` epochs
    since the last improvement; ``last_epoch`` is that epoch (or the final one
    when ``stopped`` is false) and ``best_epoch`` the first minimum up to it,
    whose weights are restored."""
    h = history.where(F.col("metric") == monitor).select("run_id", "epoch", "value")
    w = Window.partitionBy("run_id").orderBy("epoch")
    prev_best = F.min("value").over(w.rowsBetween(Window.unboundedPreceding, -1))
    h = h.withColumn("_improved", prev_best.isNull() | (F.col("value") < prev_best))
    last_imp = F.max(F.when(F.col("_improved"), F.col("epoch"))).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = h.withColumn("_wait", F.col("epoch") - last_imp)
    stops = h.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_epochs"),
        F.min(F.when((F.col("_wait") >= patience) & (F.col("epoch") > 0), F.col("epoch"))).alias("stop_epoch"))
    j = h.join(stops, "run_id")
    upto = F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch"))
    best = j.where(upto).groupBy("run_id", "n_epochs", "stop_epoch").agg(
        F.min_by("epoch", F.struct("value", "epoch")).alias("best_epoch"),
        F.min("value").alias("best_value"), F.max("epoch").alias("_last"))
    return best.select("run_id", "n_epochs", F.col("stop_epoch").isNotNull().alias("stopped"),
                       F.coalesce("stop_epoch", "_last").cast("int").alias("last_epoch"),
                       "best_epoch", "best_value")


def best_epoch(history: DataFrame) -> DataFrame:
    """First epoch with the highest val_accuracy, final values of the four series
    and the best validation accuracy per run (E10)."""
    m, v, e = F.col("metric"), F.col("value"), F.col("epoch")

    def final(name):
        return F.max_by(F.when(m == name, v), F.when(m == name, e))

    va = m == "val_accuracy"
    return history.groupBy("run_id").agg(
        F.max_by(F.when(va, e), F.when(va, F.struct(v, -e))).alias("best_epoch"),
        F.max(F.when(va, v)).alias("best_val_accuracy"),
        final("accuracy").alias("final_accuracy"), final("loss").alias("final_loss"),
        final("val_accuracy").alias("final_val_accuracy"), final("val_loss").alias("final_val_loss"))


def train_head(df: DataFrame, features_col: str = "features", label_col: str = "label",
               hidden: tuple[int, ...] = (128, 128), n_classes: int | None = None,
               seed: int = 0, max_iter: int = 100, block_size: int = 128):
    """Train the dense classifier head on frozen feature vectors (E8) with Spark
    ML's distributed multilayer perceptron (sigmoid hidden units, L-BFGS: the
    reference uses ReLU and Adam). ``features_col`` is ``ARRAY<FLOAT|DOUBLE>``.
    Returns the fitted model and the vector-typed input it was trained on."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector

    x = df.withColumn("_features", array_to_vector(F.col(features_col).cast("array<double>")))
    first = x.select(F.size(features_col).alias("d")).first()
    d = int(first["d"]) if first else 0
    k = n_classes if n_classes is not None else int(
        x.agg(F.max(label_col)).first()[0]) + 1
    mlp = MultilayerPerceptronClassifier(
        featuresCol="_features", labelCol=label_col, layers=[d, *hidden, k],
        seed=seed, maxIter=max_iter, blockSize=block_size)
    model = mlp.fit(x.withColumn(label_col, F.col(label_col).cast("double")))
    return model, x


def head_predictions(model, x: DataFrame, keep: list[str]) -> DataFrame:
    """Class id and confidence per row from a fitted head."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(x)
    probs = vector_to_array("probability")
    return out.select(*keep, F.col("prediction").cast("int").alias("y_pred"),
                      F.array_max(probs).alias("confidence"))
