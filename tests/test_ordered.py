"""Order statistics and carried values without a sort of a group in one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from imagelake.functions.carry import carry_forward
from imagelake.functions.quantiles import exact_quantiles, value_bins
from imagelake.operators.evaluate import OTHER, class_accuracy, confidence_describe, confusion_matrix

PROBS = {"q0": 0.0, "q1": 0.25, "med": 0.5, "q9": 0.9, "top": 1.0}


def test_quantiles_equal_numpy_with_a_hot_value(spark):
    n = 300_000
    # a third is one value, others are dense around it, and some lie far apart
    x = (F.when(F.col("id") % 3 == 0, 0.75).when(F.col("id") % 3 == 1, 0.75 + (F.xxhash64("id") % 1000) * 1e-13)
         .when(F.col("id") % 9 == 2, F.lit(0.0) - F.pow(F.lit(2.0), F.col("id") % 200 - 100)).otherwise(F.xxhash64("id") / 1e18))
    df = spark.range(n).select((F.col("id") % 4 == 0).alias("k"), x.alias("x"))
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "x", PROBS).collect()}
    values = df.toPandas()
    for k in (True, False):
        want = np.quantile(values.x[values.k == k].to_numpy(), list(PROBS.values()))
        assert [got[k][p] for p in PROBS] == list(want)


def test_quantiles_of_few_and_awkward_values(spark):
    rows = [("a", 5.0), ("b", 1.0), ("b", 2.0), ("c", None), ("d", 0.0), ("d", -0.0), ("d", 1e-300), ("e", 1e-300), ("e", -1e-300), ("e", 0.0),
            ("f", 1e308), ("f", -1e308), ("f", 3.0), ("g", 1.0), ("g", float(np.nextafter(1.0, 2.0))), ("g", float(np.nextafter(1.0, 0.0)))]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "x", PROBS).collect()}
    assert set(got) == set("abdefg")
    for k in got:
        want = np.quantile([x for y, x in rows if y == k], list(PROBS.values()))
        assert [got[k][p] for p in PROBS] == list(want)


def test_describe_reads_bins_not_rows(spark):
    df = spark.range(100_000).select(F.lit("r").alias("run_id"), (F.lit(1e6) + (F.col("id") % 1000) / 1000).alias("confidence"))
    r = confidence_describe(df.unionByName(spark.sql("SELECT 'none' run_id, CAST(null AS DOUBLE) confidence"))).where("run_id = 'r'").first()
    x = 1e6 + np.arange(100_000) % 1000 / 1000
    assert (r["n"], r["min"], r["max"]) == (100_000, x.min(), x.max())
    assert abs(r["std"] - x.std()) < 1e-6 and abs(r["mean"] - x.mean()) < 1e-6 and abs(r["median"] - np.median(x)) < 1e-9
    assert value_bins(df, ["run_id"], "confidence").count() < 100


def test_carry_over_ranges_of_a_hot_group(spark):
    rows = [("hot", i, i if i % 37 == 5 else None) for i in range(3000)] + [("cold", i, None) for i in range(5)] + [("x", 1, 9)]
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(7)
    got = {(r.k, r.o): r.c for r in carry_forward(df, ["k"], ["o"], "v", "c", ranges=9).collect()}
    last = {}
    for k, o, v in rows:
        last[k] = v if v is not None else last.get(k)
        assert got[k, o] == last[k]
    assert len(got) == len(rows)


def test_classes_outside_the_list_are_counted(spark):
    ev = spark.createDataFrame([("r", 0, 0), ("r", 1, 7), ("r", 7, 1), ("r", None, 0), ("r", 1, 1), ("s", 0, 1)],
                               "run_id string, y_true int, y_pred int")
    cm = {(r.run_id, r.y_true, r.y_pred): r.n for r in confusion_matrix(ev, ["a", "b"]).collect()}
    assert sum(v for k, v in cm.items() if k[0] == "r") == 5
    assert cm["r", 1, OTHER] == 1 and cm["r", OTHER, 1] == 1 and cm["r", OTHER, 0] == 1 and ("s", OTHER, 0) not in cm
    assert cm["s", 0, 0] == 0 and cm["s", 0, 1] == 1
    ca = {(r.run_id, r.name): (r.support, r.correct) for r in class_accuracy(ev, ["a", "b"]).collect()}
    assert ca == {("r", "a"): (1, 1), ("r", "b"): (2, 1), ("r", "other"): (2, 0), ("s", "a"): (1, 0), ("s", "b"): (0, 0)}
