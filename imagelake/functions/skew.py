"""Joins of raw rows to per-group statistics that survive a hot group.

Joining every row to its group's statistics (one row per group) sends all rows
of a group to one task. When one group holds a third of the data, that task
does a third of the work. ``salted_join`` splits such hot groups:

* a group is hot when it holds more than ``share`` of all rows and more than
  ``min_rows`` rows (smaller groups are cheap for one task). The threshold comes
  from a scalar subquery over the group sizes (an aggregate, no driver round
  trip), so at most ``1 / share`` groups can be hot, and the hot-key list that is
  broadcast has that proven bound;
* group sizes are taken from the statistics when they carry them, from a given
  size table, or estimated from a seeded sample of the rows (``sample``) - a
  detection step only: every row is still joined and kept;
* rows of hot groups get a salt in ``[0, salts)`` from ``xxhash64`` of the row
  (deterministic, so retries see the same salt), other rows get salt 0;
* the statistics row of a hot group is replicated once per salt;
* the join runs on (keys, salt), so a hot group spreads over ``salts`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 1e-3        # a group above 0.1 % of all rows may be split (at most 1000 hot groups)
HOT_MIN_ROWS = 1_000_000  # ... if it also has more rows than one task handles comfortably
SALTS = 64
SAMPLE = 0.01           # fraction of rows used to estimate group sizes when none are given
SAMPLE_SEED = 17


def hot_keys(sizes: DataFrame, keys: list[str], size_col: str, share: float = HOT_SHARE,
             min_rows: float = HOT_MIN_ROWS) -> DataFrame:
    """Groups holding more than ``share`` of all rows and more than ``min_rows`` rows
    (at most ``1 / share`` rows)."""
    spark = sizes.sparkSession
    cols = ", ".join(f"`{k}`" for k in keys)
    return spark.sql(
        f"SELECT {cols} FROM {{s}} WHERE `{size_col}` > {float(min_rows)!r} "
        f"AND `{size_col}` > (SELECT sum(`{size_col}`) FROM {{s}}) * {float(share)!r}",
        s=sizes)


def estimated_sizes(rows: DataFrame, keys: list[str], size_col: str = "group_size",
                    fraction: float = SAMPLE, seed: int = SAMPLE_SEED) -> DataFrame:
    """Group sizes estimated from a seeded sample of ``rows`` (scaled back up)."""
    return (rows.select(*keys).sample(False, fraction, seed).groupBy(*keys)
                .agg((F.count(F.lit(1)) / F.lit(fraction)).alias(size_col)))


def salted_join(rows: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner",
                size_col: str = "group_size", sizes: DataFrame | None = None,
                share: float = HOT_SHARE, min_rows: float = HOT_MIN_ROWS, salts: int = SALTS,
                sample: float = SAMPLE) -> DataFrame:
    """``rows`` joined to ``stats`` on ``keys`` (inner, left, left_semi or left_anti),
    with hot groups split over ``salts`` tasks. Group sizes come from ``size_col`` in
    ``stats``, from ``sizes`` (keys + size_col), or else from a ``sample`` of rows."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if sizes is None:
        sizes = (stats.select(*keys, size_col) if size_col in stats.columns
                 else estimated_sizes(rows, keys, size_col, sample))
    hot = F.broadcast(hot_keys(sizes.select(*keys, size_col), keys, size_col, share, min_rows)
                      .withColumn("_hot", F.lit(True)))
    flagged = rows.join(hot, keys, "left")
    hashable = [F.col(f.name) for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*hashable), F.lit(salts)))
    left = flagged.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int")).drop("_hot")
    right = stats.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0))))).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
