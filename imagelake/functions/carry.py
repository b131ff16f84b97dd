"""Carry a group's last known value forward without a per-group window.

``last(v) OVER (PARTITION BY k ORDER BY o)`` sorts each group inside one task. Here
the rows are range-partitioned on (k, o) and written with the number of their range,
so a large group lies in many ranges. Within a range a window carries values on;
what a range starts with comes from one row per (group, range): the last known
value at the end of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: str, out_col: str,
                  ranges: int | None = None) -> DataFrame:
    """Add ``out_col``: the last non-null ``value`` of the group at or before the row.
    ``order`` must be unique within a group. ``ranges`` defaults to the session's shuffle width."""
    checkpoint_dir(df.sparkSession)
    width = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the boundaries of a range shuffle are sampled anew each time it runs: written once
    rows = (df.repartitionByRange(width, *keys, *order).sortWithinPartitions(*keys, *order)
              .withColumn("_range", F.spark_partition_id())).checkpoint()
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    spans = rows.groupBy(*keys, "_range").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    # this window runs over one row per (group, range it spans)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(*keys, "_range", F.last("_end", ignorenulls=True).over(before).alias("_start"))
    own = rows.withColumn("_own", F.last(value, ignorenulls=True).over(within))
    return own.join(starts, [*keys, "_range"]).withColumn(out_col, F.coalesce("_own", "_start")).select(*df.columns, out_col)
