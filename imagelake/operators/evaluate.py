"""Evaluation of predictions.

Input ``eval(run_id, item_id, y_true, y_pred, confidence)``; everything is
grouped by ``run_id`` so many runs evaluate in one job. Per-class numbers come
from one partial aggregate over a stacked (true, pred) view; the class grid is
generated from the class list (``inline`` of literals), so no join multiplies
rows. Quantiles are exact (``functions.quantiles``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles, quantiles_of, value_bins
from ..functions.skew import salted_join

# fixed values: accuracy tiers and confidence bands of the evaluation report.
TIER_GREEN = 0.95
TIER_YELLOW = 0.85
BAND_HIGH = 0.95
BAND_MEDIUM = 0.80
HIST_BINS = 50
GAP_BALANCED = 0.05
GAP_SLIGHT = 0.10
AVG_DIGITS = 10  # sums over classes are rounded (summation order differs by engine)


def _hit() -> Column:
    return (F.col("y_true") == F.col("y_pred")).cast("long")


def class_grid(runs: DataFrame, class_names: list[str], prefix: str = "") -> DataFrame:
    """Every (run, class) pair, generated from the class list."""
    cls = F.array(*[F.struct(F.lit(i).cast("int").alias(f"{prefix}class_id"),
                             F.lit(n).alias(f"{prefix}name")) for i, n in enumerate(class_names)])
    return runs.select("run_id", F.inline(cls))


def accuracy(ev: DataFrame) -> DataFrame:
    """Accuracy, total, correct, incorrect per run."""
    return ev.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"), F.sum(_hit()).alias("correct")
    ).select("run_id", "total", "correct", (F.col("total") - F.col("correct")).alias("incorrect"),
             (F.col("correct") / F.col("total")).alias("accuracy"))


def per_class_counts(ev: DataFrame) -> DataFrame:
    """(run, class): support (true count), predicted count, hits - one aggregate."""
    st = ev.select("run_id", _hit().alias("_hit"), F.expr(
        "stack(2, y_true, 1L, 0L, y_pred, 0L, 1L) AS (class_id, _is_true, _is_pred)"))
    return st.groupBy("run_id", "class_id").agg(
        F.sum("_is_true").alias("support"), F.sum("_is_pred").alias("n_pred"),
        F.sum(F.col("_hit") * F.col("_is_true")).alias("hits"))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def classification_report(ev: DataFrame, class_names: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class present in the run, plus the
    ``accuracy``, ``macro avg`` and ``weighted avg`` rows (I2). Zero denominators
    give 0."""
    counts = per_class_counts(ev)
    names = class_grid(counts.select("run_id").distinct(), class_names)
    per = (counts.join(names, ["run_id", "class_id"], "left")
                 .select("run_id", "class_id", F.coalesce("name", F.col("class_id").cast("string")).alias("label"),
                         _ratio(F.col("hits"), F.col("n_pred")).alias("precision"),
                         _ratio(F.col("hits"), F.col("support")).alias("recall"), "support"))
    per = per.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0,
                                            2 * F.col("precision") * F.col("recall")
                                            / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    rnd = lambda c: F.round(c, AVG_DIGITS)
    tot = F.sum("support")
    avgs = per.groupBy("run_id").agg(
        rnd(F.avg("precision")).alias("m_p"), rnd(F.avg("recall")).alias("m_r"),
        rnd(F.avg("f1_score")).alias("m_f"),
        rnd(F.sum(F.col("precision") * F.col("support")) / tot).alias("w_p"),
        rnd(F.sum(F.col("recall") * F.col("support")) / tot).alias("w_r"),
        rnd(F.sum(F.col("f1_score") * F.col("support")) / tot).alias("w_f"),
        tot.alias("n"))
    acc = accuracy(ev).select("run_id", "accuracy")

    def row(label, precision, recall, f1):
        return F.struct(F.lit(label).alias("label"), precision.cast("double").alias("precision"),
                        recall.cast("double").alias("recall"), F.col("n").alias("support"),
                        f1.cast("double").alias("f1_score"))

    summary = avgs.join(acc, "run_id").select("run_id", F.inline(F.array(
        row("accuracy", F.lit(None), F.lit(None), F.col("accuracy")),
        row("macro avg", F.col("m_p"), F.col("m_r"), F.col("m_f")),
        row("weighted avg", F.col("w_p"), F.col("w_r"), F.col("w_f")))))
    cols = ["run_id", "label", "precision", "recall", "f1_score", "support"]
    return per.select(*cols).unionByName(summary.select(*cols))


OTHER = -1  # class id of anything outside the class list


def listed(class_id: str, n: int) -> Column:
    """The class id where the list has it, else ``OTHER`` (also for null)."""
    return F.when(F.col(class_id).between(0, n - 1), F.col(class_id)).otherwise(F.lit(OTHER)).cast("int")


def confusion_matrix(ev: DataFrame, class_names: list[str]) -> DataFrame:
    """Long confusion matrix (I3): one row per (run, true class, predicted class),
    zeros kept for every pair of the class list. Class ids outside the list are counted as class
    ``OTHER``; its pairs appear only where there are some."""
    n = len(class_names)
    counts = ev.select("run_id", listed("y_true", n).alias("y_true"), listed("y_pred", n).alias("y_pred")).groupBy(
        "run_id", "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))
    pair = lambda t, p: t * (n + 1) + p
    # a run's pairs, at most (n + 1)^2, as one map: the grid needs neither a join nor a second scan
    runs = counts.groupBy("run_id").agg(F.map_from_entries(F.collect_list(
        F.struct(pair(F.col("y_true"), F.col("y_pred")), "n"))).alias("_n"))
    ids = ", ".join(map(str, (*range(n), OTHER)))
    grid = F.expr(f"inline(flatten(transform(array({ids}), t -> transform(array({ids}), "
                  "p -> named_struct('y_true', t, 'y_pred', p)))))")
    rows = runs.select("run_id", "_n", grid).withColumn(
        "n", F.coalesce(F.try_element_at("_n", pair(F.col("y_true"), F.col("y_pred"))), F.lit(0)).cast("long"))
    return rows.where((F.col("n") > 0) | ((F.col("y_true") != OTHER) & (F.col("y_pred") != OTHER))).select(
        "run_id", "y_true", "y_pred", "n")


def confusion_wide(ev: DataFrame, class_names: list[str]) -> DataFrame:
    """Wide confusion matrix (I3): rows true class, one column ``pred_<id>`` per class."""
    long = confusion_matrix(ev, class_names)
    return long.groupBy("run_id", "y_true").agg(*[F.sum(F.when(F.col("y_pred") == i, F.col("n"))).alias(f"pred_{i}")
                                                  for i in range(len(class_names))])


def class_accuracy(ev: DataFrame, class_names: list[str]) -> DataFrame:
    """Recall per class (diagonal / row sum, 0 without support) and its tier (I4). Rows whose
    true class is outside the list are one more class, ``OTHER``, named ``other``."""
    names = [*class_names, "other"]
    counts = ev.groupBy("run_id", listed("y_true", len(class_names)).alias("class_id")).agg(
        F.count(F.lit(1)).alias("support"), F.sum(_hit()).alias("hits"))
    # one map per run, bounded by the class list: no join and no second scan for the grid
    runs = counts.groupBy("run_id").agg(F.map_from_entries(F.collect_list(
        F.struct("class_id", F.struct("support", "hits")))).alias("_of"))
    grid = F.array(*[F.struct(F.lit(i).alias("class_id"), F.lit(c).alias("name"))
                     for i, c in zip((*range(len(class_names)), OTHER), names)])
    of = F.try_element_at("_of", F.col("class_id"))
    j = runs.select("run_id", "_of", F.inline(grid)).withColumn("support", F.coalesce(of["support"], F.lit(0)).cast("long")).withColumn(
        "correct", F.coalesce(of["hits"], F.lit(0)).cast("long"))
    acc = _ratio(F.col("correct"), F.col("support"))
    tier = F.when(acc >= TIER_GREEN, "green").when(acc >= TIER_YELLOW, "yellow").otherwise("red")
    return j.where((F.col("class_id") != OTHER) | (F.col("support") > 0)).select(
        "run_id", "class_id", "name", "correct", "support", acc.alias("accuracy"), tier.alias("tier"))


def best_worst(ev: DataFrame, class_names: list[str]) -> DataFrame:
    """Mean, best and worst class accuracy per run (I5); ties go to the first class id."""
    ca = class_accuracy(ev, class_names).where(F.col("class_id") != OTHER)
    return ca.groupBy("run_id").agg(
        F.round(F.avg("accuracy"), AVG_DIGITS).alias("mean_class_accuracy"),
        F.max_by("name", F.struct(F.col("accuracy"), -F.col("class_id"))).alias("best_class"),
        F.max("accuracy").alias("best_accuracy"),
        F.min_by("name", F.struct(F.col("accuracy"), F.col("class_id"))).alias("worst_class"),
        F.min("accuracy").alias("worst_accuracy"))


def moments(bins: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """run_id, n, mean, std, min, max of all values, from their bins (``value_bins``): the
    squares of a bin are taken around its own mean, so nothing cancels."""
    run = Window.partitionBy("run_id")  # over bins
    mean = F.sum("total").over(run) / F.sum("n").over(run)
    apart = F.col("total") / F.col("n") - F.col("_mean")
    return bins.withColumn("_mean", mean).groupBy("run_id").agg(
        F.sum("n").alias("n"), F.first("_mean", ignorenulls=True).alias("mean"),
        F.sqrt(F.sum(F.col("n") * (F.col("var") + apart * apart)) / F.sum("n")).alias("std"),
        F.min("lo").alias("min"), F.max("hi").alias("max"), *[c.alias(k) for k, c in (extra or {}).items()])


def confidence_describe(ev: DataFrame, exact: bool = True) -> DataFrame:
    """Mean, median, population std (rounded to 6), min, max per run.
    ``exact`` reads the rows twice (value bins, and the bin of the median); otherwise
    ``percentile_approx``."""
    if exact:
        bins = value_bins(ev, ["run_id"], "confidence")
        med = quantiles_of(ev, bins, ["run_id"], "confidence", {"median": 0.5})
        base = moments(bins).select("run_id", "n", "mean", F.round("std", 6).alias("std"), "min", "max")
    else:
        med = ev.groupBy("run_id").agg(F.percentile_approx("confidence", 0.5, 10000).alias("median"))
        base = ev.groupBy("run_id").agg(
            F.count("confidence").alias("n"), F.avg("confidence").alias("mean"),
            F.round(F.stddev_pop("confidence"), 6).alias("std"),
            F.min("confidence").alias("min"), F.max("confidence").alias("max"))
    return base.join(med, "run_id", "left").select("run_id", "n", "mean", "median", "std", "min", "max")


def confidence_bands(ev: DataFrame) -> DataFrame:
    """Counts and shares of high (>= 0.95), medium (0.80-0.95) and low (< 0.80)
    confidence per run (I7); every band is present."""
    c = F.col("confidence")
    per = ev.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("_total"),
        F.count(F.when(c >= BAND_HIGH, 1)).alias("high"),
        F.count(F.when((c >= BAND_MEDIUM) & (c < BAND_HIGH), 1)).alias("medium"),
        F.count(F.when(c < BAND_MEDIUM, 1)).alias("low"))
    long = per.select("run_id", "_total", F.expr(
        "stack(3, 'high', high, 'medium', medium, 'low', low) AS (band, n)"))
    return long.select("run_id", "band", "n", (F.col("n") / F.col("_total")).alias("share"))


def confidence_by_correctness(ev: DataFrame) -> DataFrame:
    """Mean confidence of right and of wrong predictions, 0 when none is wrong (I8)."""
    hit = F.col("y_true") == F.col("y_pred")
    return ev.groupBy("run_id").agg(
        F.avg(F.when(hit, F.col("confidence"))).alias("avg_conf_correct"),
        F.coalesce(F.avg(F.when(~hit, F.col("confidence"))), F.lit(0.0)).alias("avg_conf_incorrect"))


def confidence_histogram(ev: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """``bins`` equal-width bins over [min, max] per run, last bin closed (I9);
    empty bins kept. A zero range puts every value in the middle bin."""
    rng = ev.groupBy("run_id").agg(F.min("confidence").alias("_lo"), F.max("confidence").alias("_hi"),
                                   F.count(F.lit(1)).alias("_rows"))
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width > 0, F.least(F.floor((F.col("confidence") - F.col("_lo")) / width * bins),
                                  F.lit(bins - 1))).otherwise(F.lit(bins // 2)).cast("int")
    # every row meets its run's range: a hot run is salted over many tasks
    joined = salted_join(ev.select("run_id", "confidence"), rng, ["run_id"], "inner", size_col="_rows")
    counts = (joined.select("run_id", b.alias("bin")).groupBy("run_id", "bin")
                    .agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select("run_id", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge = lambda k: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * k / bins
    return (grid.join(counts, ["run_id", "bin"], "left")
                .select("run_id", "bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"),
                        F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def box_stats(ev: DataFrame) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 IQR) and outlier count for
    right and wrong predictions per run (I10)."""
    x = ev.select("run_id", (F.col("y_true") == F.col("y_pred")).alias("correct"), "confidence")
    q = exact_quantiles(x, ["run_id", "correct"], "confidence", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_fence = F.col("q1") - 1.5 * F.col("iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("iqr")
    c = F.col("confidence")
    sizes = x.groupBy("run_id", "correct").agg(F.count(F.lit(1)).alias("_rows"))
    joined = salted_join(x, q, ["run_id", "correct"], "inner", size_col="_rows", sizes=sizes)
    out = joined.groupBy("run_id", "correct", "q1", "median", "q3", "iqr").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(c >= lo_fence, c)).alias("whisker_lo"),
        F.max(F.when(c <= hi_fence, c)).alias("whisker_hi"),
        F.count(F.when((c < lo_fence) | (c > hi_fence), 1)).alias("n_outliers"))
    return out


# fixed values: the four series of a training history.
HISTORY_METRICS = ["accuracy", "val_accuracy", "loss", "val_loss"]


def learning_curves(history: DataFrame) -> DataFrame:
    """One row per (run, epoch) with the four series side by side."""
    return history.groupBy("run_id", "epoch").pivot("metric", HISTORY_METRICS).agg(F.first("value"))


def overfit_gap(history: DataFrame) -> DataFrame:
    """Final train and validation accuracy, their gap and a verdict (I12):
    gap < 0.05 balanced, < 0.10 slight overfit, else overfit."""
    m = F.col("metric")
    fin = history.groupBy("run_id").agg(
        F.max_by(F.when(m == "accuracy", F.col("value")), F.when(m == "accuracy", F.col("epoch"))).alias("final_train_acc"),
        F.max_by(F.when(m == "val_accuracy", F.col("value")),
                 F.when(m == "val_accuracy", F.col("epoch"))).alias("final_val_acc"))
    gap = F.abs(F.col("final_train_acc") - F.col("final_val_acc"))
    return fin.withColumn("gap", gap).withColumn(
        "verdict", F.when(gap < GAP_BALANCED, "balanced").when(gap < GAP_SLIGHT, "slight overfit")
        .otherwise("overfit"))
