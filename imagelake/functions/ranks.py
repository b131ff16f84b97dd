"""Row numbers within groups without a per-group window.

``row_number() OVER (PARTITION BY k ORDER BY o)`` sorts each group inside one
task, so a group holding a third of all rows lands on one executor. Here rows
are range-partitioned on (k, o), so a large group is spread over many
partitions by its order columns; per-(partition, group) counts - a small table
with one row per partition a group spans - are turned into starting offsets,
and each row's number is its offset plus its position inside the sorted
partition (``monotonically_increasing_id`` taken right after the sort).

The sorted rows are checkpointed with their partition numbers before anything is
counted: the boundaries of a range shuffle are sampled anew each time its plan
runs, so numbers from two runs of it must never be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def group_row_number(df: DataFrame, keys: list[str], order: list[str | Column],
                     out_col: str = "row_no") -> DataFrame:
    """Add ``out_col``: 0-based position of each row within its ``keys`` group in
    ``order``. Give an order that is unique within a group for repeatable numbers."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranked = (df.repartitionByRange(*keys, *order_cols).sortWithinPartitions(*keys, *order_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    checkpoint_dir(df.sparkSession)
    ranked = ranked.checkpoint()
    parts = ranked.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_mid0"))
    # this window runs over `parts`: one row per (group, partition it spans)
    offsets = parts.withColumn(
        "_off", F.sum("_cnt").over(Window.partitionBy(*keys).orderBy("_pid")) - F.col("_cnt"))
    return (ranked.join(offsets.select(*keys, "_pid", "_off", "_mid0"), [*keys, "_pid"])
                  .withColumn(out_col, F.col("_off") + F.col("_mid") - F.col("_mid0"))
                  .drop("_pid", "_mid", "_off", "_mid0"))


def group_sizes(df: DataFrame, keys: list[str], out_col: str = "group_size") -> DataFrame:
    """Rows per group (a partial aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out_col))
