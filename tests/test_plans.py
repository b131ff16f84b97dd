"""Physical-plan checks: no cross products, broadcasts only for the bounded
dimensions, per-group limits before the shuffle, pruned scans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sf_dirs import SF_SMALL
from imagelake import fixtures as fx
from imagelake.operators.sessions import session_preview
from imagelake.plans.session_report import session_report
from imagelake.sources.fetch import predictions_scan


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_products_or_row_udfs(spark, name):
    if name == "E8_train_head":
        pytest.skip("model training runs at definition time")
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF; Arrow batches only


def test_flagship_broadcasts_dimensions_and_prunes_columns(spark):
    plan = _plan(session_report(spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 2
    scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "events" in ln]
    assert scan and "value" not in scan[0].split("ReadSchema")[1]


def test_session_preview_limits_before_shuffle(spark):
    up = fx.pred_log(spark, SF_SMALL).select("session_id", "filename", F.col("received_at").alias("uploaded_at"))
    df = session_preview(up, 5)
    df.collect()
    assert "WindowGroupLimit" in _plan(df)


def test_log_scan_pushes_session_filter(spark, scratch):
    log = fx.pred_log(spark, SF_SMALL).select("session_id", "filename", "confidence")
    log.write.parquet(scratch + "/log")
    one = predictions_scan(spark, scratch + "/log", session_id="u8-20240101")
    plan = _plan(one)
    assert "PushedFilters: [IsNotNull(session_id), EqualTo(session_id,u8-20240101)]" in plan


def _hot_sessions(spark, n=30000):
    # one session holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string"))).alias("session_id"), "id")


def test_salted_join_splits_a_hot_group_and_keeps_the_answer(spark):
    from imagelake.functions.skew import hot_keys, salted_join
    df = _hot_sessions(spark)
    counts = df.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    assert [r.session_id for r in hot_keys(counts, ["session_id"], "n", share=0.01, min_rows=1000).collect()] == ["hot"]
    assert hot_keys(counts, ["session_id"], "n", share=0.01).count() == 0  # below the row floor
    stats = counts.withColumn("stat", F.col("n") * 2)
    a = salted_join(df, stats, ["session_id"], "inner", size_col="n", share=0.01, min_rows=1000, salts=8)
    b = df.join(stats, "session_id")
    assert sorted(a.select("id", "stat").collect()) == sorted(b.select("id", "stat").collect())
    assert "_salt" in _plan(a)
    left = sorted(r.id for r in salted_join(df, stats.where("n < 10"), ["session_id"], "left_anti",
                                            size_col="n", share=0.01, min_rows=1000, sizes=counts).collect())
    # sizes estimated from a sample find the same hot group
    from imagelake.functions.skew import estimated_sizes
    est = estimated_sizes(df, ["session_id"], "n", fraction=0.1)
    assert [r.session_id for r in hot_keys(est, ["session_id"], "n", share=0.01, min_rows=1000).collect()] == ["hot"]
    c = salted_join(df, stats.drop("n"), ["session_id"], "inner", size_col="n", share=0.01, min_rows=1000,
                    salts=8, sample=0.1)
    assert sorted(c.select("id", "stat").collect()) == sorted(b.select("id", "stat").collect())
    assert left == sorted(r.id for r in df.join(stats.where("n < 10"), "session_id", "left_anti").collect())


def test_session_cap_rejects_a_hot_session_whole(spark):
    from imagelake.operators.validate import session_cap
    df = _hot_sessions(spark)
    kept = session_cap(df, n=10)
    assert kept.where("session_id = 'hot'").count() == 0
    assert kept.count() == df.where("session_id != 'hot'").count()


# Windows allowed over raw rows, and why.
RAW_WINDOWS = {
    "G8_session_preview": "row_number() <= k, planned with a partial WindowGroupLimit",
    "E7_sampled_inference": "one row per block of frames, within a range of a written range shuffle",
    "E7_gapped_frames": "as E7_sampled_inference",
    "I6_confidence_describe": "over written bin counts", "I10_box_stats": "over written bin counts",
    "I13_model_report": "over written bin counts", "I13_per_class_map_size": "over written bin counts",
    "B6_report_sink": "over written bin counts",
    "op4_best_fit_packing": "ranks within a length and hash bucket of some 2,000 written rows",
    "op5_mixing": "sums within a source's bucket of some 4,000 written rows, and within a range of the sort",
    "pipeline": "ends with op4_best_fit_packing",
    "E9_early_stop": "per-run training history, bounded by the epoch count",
}


def _windows_over_raw_rows(plan) -> int:
    """Window nodes of an optimized logical plan with no Aggregate below them."""
    def name(node):
        return node.getClass().getSimpleName()

    def children(node):
        ch = node.children()
        return [ch.apply(i) for i in range(ch.size())]

    def has_agg(node):
        return name(node) == "Aggregate" or any(has_agg(c) for c in children(node))

    def walk(node):
        own = 1 if name(node) == "Window" and not has_agg(node) else 0
        return own + sum(walk(c) for c in children(node))

    return walk(plan)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_windows_run_over_aggregates(spark, name):
    if name in RAW_WINDOWS or name in ("E8_train_head",):
        pytest.skip(RAW_WINDOWS.get(name, "model training"))
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan()
    assert _windows_over_raw_rows(plan) == 0


def test_window_detector_sees_raw_windows(spark):
    plan = E.queries()["G8_session_preview"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan()
    assert _windows_over_raw_rows(plan) >= 1


def test_hot_picture_is_split_by_adaptive_skew_join(spark):
    from imagelake.sources.fetch import image_fetch
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        reqs = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("object_key"), "id")
        imgs = spark.range(5000).select(F.col("id").alias("object_key"), F.lit(4).alias("height"))
        j = image_fetch(reqs, imgs)
        assert j.where("fetch_error IS NULL").count() == 30000
        j.collect()
        assert "SortMergeJoin(skew=true)" in _plan(j)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_partition_plan_scales_with_input():
    from imagelake.session import MAX_SHUFFLE_PARTITIONS, partition_plan
    small = partition_plan(10 * 1024 ** 2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"          # two waves of 8 cores
    tb100 = partition_plan(100 * 1024 ** 4, total_cores=8000)
    assert int(tb100["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    mid = partition_plan(1024 ** 4, total_cores=1000)                # 1 TiB / 256 MiB = 4096
    assert mid["spark.sql.shuffle.partitions"] == "4096"
    assert mid["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


def test_salted_join_with_map_columns(spark):
    from imagelake.functions.skew import salted_join
    df = _hot_sessions(spark, 3000).withColumn("m", F.create_map(F.lit("k"), F.col("id")))
    counts = df.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    out = salted_join(df, counts, ["session_id"], "inner", size_col="n", share=0.01, min_rows=100, salts=4)
    assert out.count() == 3000


def test_landing_scan_is_pruned_to_the_batch_dates(spark, scratch):
    from imagelake.sources.fetch import image_fetch, landed_for
    spark.range(300).select(
        (F.col("id") % 30).cast("string").alias("object_key"),
        F.concat(F.lit("2024010"), (F.col("id") % 9 + 1).cast("string")).alias("upload_date"),
        F.lit(4).alias("height")).write.partitionBy("upload_date").parquet(scratch + "/landed")
    landed = spark.read.parquet(scratch + "/landed")
    reqs = spark.createDataFrame([("1", "20240103"), ("2", "20240103"), ("3", "20240105")],
                                 "object_key string, upload_date string")
    pruned = image_fetch(reqs, landed_for(reqs, landed), ["upload_date", "object_key"])
    filters = [ln for ln in _plan(pruned).splitlines() if "PartitionFilters" in ln]
    assert filters and all("20240103" in ln and "20240105" in ln for ln in filters)
    unpruned = image_fetch(reqs, landed, ["upload_date", "object_key"])
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, unpruned.collect()))


def test_size_for_keeps_explicit_cluster_settings(spark):
    from imagelake.session import size_for
    explicit = dict(spark.sparkContext.getConf().getAll())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = size_for(spark, 10 * 1024 ** 2)
    # the test session sets shuffle partitions explicitly, so it is kept
    assert "spark.sql.shuffle.partitions" in explicit
    assert got["spark.sql.shuffle.partitions"] == before
    assert got["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 ** 2))


def test_checkpoint_dir_refuses_local_folders_on_a_cluster():
    from imagelake.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
