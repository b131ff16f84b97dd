"""Registered queries: evaluation (I1-I13) and training history."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..dims import CLASS_NAMES
from ..operators import evaluate as ev_ops
from ..operators import training
from ..operators.report import report_columns
from ..oracle import cte
from ..registry import register

EV = cte("eval", "class_dim")
HIST = cte("history")


def _ev(spark, sf):
    return fx.eval_rows(spark, sf)


@register("I1_accuracy", EV + """
SELECT run_id, count(*) AS total, CAST(sum(CAST(y_true = y_pred AS BIGINT)) AS BIGINT) AS correct,
  CAST(count(*) - sum(CAST(y_true = y_pred AS BIGINT)) AS BIGINT) AS incorrect,
  sum(CAST(y_true = y_pred AS BIGINT)) / count(*) AS accuracy
FROM eval GROUP BY run_id""")
def q_i1(spark, sf):
    return ev_ops.accuracy(_ev(spark, sf))


COUNTS = """
, st AS (
  SELECT run_id, y_true AS class_id, 1 AS is_true, 0 AS is_pred, CAST(y_true = y_pred AS BIGINT) AS hit FROM eval
  UNION ALL
  SELECT run_id, y_pred AS class_id, 0 AS is_true, 1 AS is_pred, CAST(y_true = y_pred AS BIGINT) AS hit FROM eval),
counts AS (
  SELECT run_id, class_id, CAST(sum(is_true) AS BIGINT) AS support, CAST(sum(is_pred) AS BIGINT) AS n_pred,
    CAST(sum(hit * is_true) AS BIGINT) AS hits
  FROM st GROUP BY run_id, class_id)"""


@register("I2_classification_report", EV + COUNTS + """
, per AS (
  SELECT c.run_id, c.class_id, coalesce(d.name, CAST(c.class_id AS VARCHAR)) AS label,
    CASE WHEN n_pred > 0 THEN hits / n_pred ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall, support
  FROM counts c LEFT JOIN class_dim d ON c.class_id = d.class_id),
per2 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
    ELSE 0.0 END AS f1_score FROM per),
avgs AS (
  SELECT run_id, round(avg(precision), 10) AS m_p, round(avg(recall), 10) AS m_r, round(avg(f1_score), 10) AS m_f,
    round(sum(precision * support) / sum(support), 10) AS w_p,
    round(sum(recall * support) / sum(support), 10) AS w_r,
    round(sum(f1_score * support) / sum(support), 10) AS w_f,
    CAST(sum(support) AS BIGINT) AS n
  FROM per2 GROUP BY run_id),
acc AS (SELECT run_id, sum(CAST(y_true = y_pred AS BIGINT)) / count(*) AS accuracy FROM eval GROUP BY run_id)
SELECT run_id, label, precision, recall, f1_score, support FROM per2
UNION ALL SELECT a.run_id, 'accuracy', NULL, NULL, acc.accuracy, a.n FROM avgs a JOIN acc USING (run_id)
UNION ALL SELECT run_id, 'macro avg', m_p, m_r, m_f, n FROM avgs
UNION ALL SELECT run_id, 'weighted avg', w_p, w_r, w_f, n FROM avgs""")
def q_i2(spark, sf):
    return ev_ops.classification_report(_ev(spark, sf), CLASS_NAMES)


GRID = """
, grid AS (
  SELECT r.run_id, CAST(a.i AS INTEGER) AS y_true, CAST(b.i AS INTEGER) AS y_pred
  FROM (SELECT DISTINCT run_id FROM eval) r, range(0, 15) a(i), range(0, 15) b(i)),
cm AS (
  SELECT g.run_id, g.y_true, g.y_pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM grid g LEFT JOIN (SELECT run_id, y_true, y_pred, count(*) AS n FROM eval GROUP BY ALL) c
    ON g.run_id = c.run_id AND g.y_true = c.y_true AND g.y_pred = c.y_pred)"""


@register("I3_confusion_matrix", EV + GRID + """
SELECT run_id, y_true, y_pred, n FROM cm""")
def q_i3(spark, sf):
    return ev_ops.confusion_matrix(_ev(spark, sf), CLASS_NAMES)


_wide_cols = ",\n  ".join(
    f"CAST(sum(n) FILTER (WHERE y_pred = {i}) AS BIGINT) AS pred_{i}" for i in range(len(CLASS_NAMES)))


@register("I3_confusion_wide", EV + GRID + f"""
SELECT run_id, y_true,
  {_wide_cols}
FROM cm GROUP BY run_id, y_true""")
def q_i3w(spark, sf):
    return ev_ops.confusion_wide(_ev(spark, sf), CLASS_NAMES)


CLASS_ACC = EV + COUNTS + """
, cgrid AS (SELECT r.run_id, d.class_id, d.name FROM (SELECT DISTINCT run_id FROM eval) r, class_dim d),
ca AS (
  SELECT g.run_id, g.class_id, g.name, CAST(coalesce(c.hits, 0) AS BIGINT) AS correct,
    CAST(coalesce(c.support, 0) AS BIGINT) AS support,
    CASE WHEN coalesce(c.support, 0) > 0 THEN coalesce(c.hits, 0) / c.support ELSE 0.0 END AS accuracy
  FROM cgrid g LEFT JOIN counts c ON g.run_id = c.run_id AND g.class_id = c.class_id)"""


@register("I4_class_accuracy", CLASS_ACC + """
SELECT run_id, class_id, name, correct, support, accuracy,
  CASE WHEN accuracy >= 0.95 THEN 'green' WHEN accuracy >= 0.85 THEN 'yellow' ELSE 'red' END AS tier
FROM ca""")
def q_i4(spark, sf):
    return ev_ops.class_accuracy(_ev(spark, sf), CLASS_NAMES)


@register("I5_best_worst_class", CLASS_ACC + """
SELECT run_id, round(avg(accuracy), 10) AS mean_class_accuracy,
  first(name ORDER BY accuracy DESC, class_id ASC) AS best_class, max(accuracy) AS best_accuracy,
  first(name ORDER BY accuracy ASC, class_id ASC) AS worst_class, min(accuracy) AS worst_accuracy
FROM ca GROUP BY run_id""")
def q_i5(spark, sf):
    return ev_ops.best_worst(_ev(spark, sf), CLASS_NAMES)


@register("I6_confidence_describe", EV + """
SELECT run_id, count(confidence) AS n, avg(confidence) AS mean, quantile_cont(confidence, 0.5) AS median,
  round(stddev_pop(confidence), 6) AS std, min(confidence) AS min, max(confidence) AS max
FROM eval GROUP BY run_id""")
def q_i6(spark, sf):
    return ev_ops.confidence_describe(_ev(spark, sf))


@register("I7_confidence_bands", EV + """
, per AS (
  SELECT run_id, count(*) AS total,
    count(*) FILTER (WHERE confidence >= 0.95) AS high,
    count(*) FILTER (WHERE confidence >= 0.80 AND confidence < 0.95) AS medium,
    count(*) FILTER (WHERE confidence < 0.80) AS low
  FROM eval GROUP BY run_id)
SELECT run_id, 'high' AS band, high AS n, high / total AS share FROM per
UNION ALL SELECT run_id, 'medium', medium, medium / total FROM per
UNION ALL SELECT run_id, 'low', low, low / total FROM per""")
def q_i7(spark, sf):
    return ev_ops.confidence_bands(_ev(spark, sf))


@register("I8_confidence_by_correctness", EV + """
SELECT run_id, avg(confidence) FILTER (WHERE y_true = y_pred) AS avg_conf_correct,
  coalesce(avg(confidence) FILTER (WHERE y_true <> y_pred), 0.0) AS avg_conf_incorrect
FROM eval GROUP BY run_id""")
def q_i8(spark, sf):
    return ev_ops.confidence_by_correctness(_ev(spark, sf))


@register("I9_confidence_histogram", EV + """
, rng AS (SELECT run_id, min(confidence) AS lo_, max(confidence) AS hi_ FROM eval GROUP BY run_id),
counts AS (
  SELECT e.run_id, CAST(CASE WHEN hi_ - lo_ > 0
      THEN least(floor((confidence - lo_) / (hi_ - lo_) * 50), 49) ELSE 25 END AS INTEGER) AS bin,
    count(*) AS n
  FROM eval e JOIN rng r ON e.run_id = r.run_id GROUP BY ALL),
grid AS (SELECT run_id, lo_, hi_, CAST(b AS INTEGER) AS bin FROM rng, range(0, 50) t(b))
SELECT g.run_id, g.bin, lo_ + (hi_ - lo_) * g.bin / 50 AS lo, lo_ + (hi_ - lo_) * (g.bin + 1) / 50 AS hi,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN counts c ON g.run_id = c.run_id AND g.bin = c.bin""")
def q_i9(spark, sf):
    return ev_ops.confidence_histogram(_ev(spark, sf))


@register("I10_box_stats", EV + """
, x AS (SELECT run_id, y_true = y_pred AS correct, confidence FROM eval),
q AS (
  SELECT run_id, correct, quantile_cont(confidence, 0.25) AS q1, quantile_cont(confidence, 0.5) AS median,
    quantile_cont(confidence, 0.75) AS q3
  FROM x GROUP BY run_id, correct)
SELECT q.run_id, q.correct, q1, median, q3, q3 - q1 AS iqr, count(*) AS n,
  min(confidence) FILTER (WHERE confidence >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
  max(confidence) FILTER (WHERE confidence <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  count(*) FILTER (WHERE confidence < q1 - 1.5 * (q3 - q1) OR confidence > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM x JOIN q ON x.run_id = q.run_id AND x.correct = q.correct
GROUP BY q.run_id, q.correct, q1, median, q3""")
def q_i10(spark, sf):
    return ev_ops.box_stats(_ev(spark, sf))


@register("I11_learning_curves", HIST + """
SELECT run_id, epoch,
  first(value) FILTER (WHERE metric = 'accuracy') AS accuracy,
  first(value) FILTER (WHERE metric = 'val_accuracy') AS val_accuracy,
  first(value) FILTER (WHERE metric = 'loss') AS loss,
  first(value) FILTER (WHERE metric = 'val_loss') AS val_loss
FROM history GROUP BY run_id, epoch""")
def q_i11(spark, sf):
    return ev_ops.learning_curves(fx.history(spark, sf))


@register("I12_overfit_gap", HIST + """
, fin AS (
  SELECT run_id, arg_max(value, epoch) FILTER (WHERE metric = 'accuracy') AS final_train_acc,
    arg_max(value, epoch) FILTER (WHERE metric = 'val_accuracy') AS final_val_acc
  FROM history GROUP BY run_id)
SELECT run_id, final_train_acc, final_val_acc, abs(final_train_acc - final_val_acc) AS gap,
  CASE WHEN abs(final_train_acc - final_val_acc) < 0.05 THEN 'balanced'
       WHEN abs(final_train_acc - final_val_acc) < 0.10 THEN 'slight overfit' ELSE 'overfit' END AS verdict
FROM fin""")
def q_i12(spark, sf):
    return ev_ops.overfit_gap(fx.history(spark, sf))


E10_SQL = """
SELECT run_id,
  first(epoch ORDER BY value DESC, epoch ASC) FILTER (WHERE metric = 'val_accuracy') AS best_epoch,
  max(value) FILTER (WHERE metric = 'val_accuracy') AS best_val_accuracy,
  arg_max(value, epoch) FILTER (WHERE metric = 'accuracy') AS final_accuracy,
  arg_max(value, epoch) FILTER (WHERE metric = 'loss') AS final_loss,
  arg_max(value, epoch) FILTER (WHERE metric = 'val_accuracy') AS final_val_accuracy,
  arg_max(value, epoch) FILTER (WHERE metric = 'val_loss') AS final_val_loss
FROM history GROUP BY run_id"""


@register("E10_best_epoch", HIST + E10_SQL)
def q_e10(spark, sf):
    return training.best_epoch(fx.history(spark, sf))


@register("E9_early_stop", HIST + """
, h AS (SELECT run_id, epoch, value FROM history WHERE metric = 'val_loss'),
h2 AS (SELECT *, min(value) OVER (PARTITION BY run_id ORDER BY epoch
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM h),
h3 AS (SELECT *, prev_best IS NULL OR value < prev_best AS improved FROM h2),
h4 AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wait FROM h3),
stops AS (SELECT run_id, count(*) AS n_epochs,
  min(CASE WHEN wait >= 3 AND epoch > 0 THEN epoch END) AS stop_epoch FROM h4 GROUP BY run_id)
SELECT s.run_id, s.n_epochs, s.stop_epoch IS NOT NULL AS stopped,
  CAST(coalesce(s.stop_epoch, max(h.epoch)) AS INTEGER) AS last_epoch,
  first(h.epoch ORDER BY h.value, h.epoch) AS best_epoch, min(h.value) AS best_value
FROM h JOIN stops s ON h.run_id = s.run_id
WHERE s.stop_epoch IS NULL OR h.epoch <= s.stop_epoch
GROUP BY s.run_id, s.n_epochs, s.stop_epoch""")
def q_e9(spark, sf):
    return training.early_stop(fx.history(spark, sf))


@register("I13_model_report", cte("eval", "class_dim", "history") + """
, acc AS (SELECT run_id, sum(CAST(y_true = y_pred AS BIGINT)) / count(*) AS test_accuracy, count(*) AS predictions_total,
    CAST(sum(CAST(y_true = y_pred AS BIGINT)) AS BIGINT) AS predictions_correct,
    CAST(count(*) - sum(CAST(y_true = y_pred AS BIGINT)) AS BIGINT) AS predictions_incorrect
  FROM eval GROUP BY run_id),
conf AS (SELECT run_id, avg(confidence) AS conf_mean, quantile_cont(confidence, 0.5) AS conf_median,
    round(stddev_pop(confidence), 6) AS conf_std, min(confidence) AS conf_min, max(confidence) AS conf_max
  FROM eval GROUP BY run_id),
train AS (""" + E10_SQL + """)
SELECT a.*, c.conf_mean, c.conf_median, c.conf_std, c.conf_min, c.conf_max,
  t.best_epoch, t.best_val_accuracy, t.final_accuracy, t.final_loss, t.final_val_accuracy, t.final_val_loss
FROM acc a JOIN conf c ON a.run_id = c.run_id LEFT JOIN train t ON a.run_id = t.run_id""")
def q_i13(spark, sf):
    cols = report_columns(_ev(spark, sf), fx.history(spark, sf), CLASS_NAMES)
    return cols.drop("per_class_accuracy")


@register("I13_per_class_map_size", EV + """
SELECT DISTINCT run_id, 15 AS n_classes, CAST(1 AS BIGINT) AS n_reports FROM eval""")
def q_i13m(spark, sf):
    # the per-class map of each report has one entry per class
    cols = report_columns(_ev(spark, sf), fx.history(spark, sf), CLASS_NAMES)
    return cols.groupBy("run_id").agg(F.max(F.size("per_class_accuracy")).alias("n_classes"),
                                      F.count(F.lit(1)).alias("n_reports"))
