"""Exact quantiles by narrowing value brackets: no sort of raw rows, no group in one task.

1. One aggregate counts the rows of each group per value bin. Bins are steps of a
   logarithm, a function that never falls, so they are in the order of the values; a
   group has at most some 100,000, however many rows it has.
2. Running counts over the bins say which of them hold the wanted ranks. A bin of one
   value answers its ranks at once, whatever its size (a hot value).
3. The rows of the other wanted bins, a small share, are counted again in finer equal
   steps between the bin's smallest and largest value, until every wanted bracket is
   a single value. Two aggregates nearly always do.

Ranks are interpolated linearly (as ``percentile`` and DuckDB's ``quantile_cont`` do).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .skew import salted_join

#: Bins per unit of the natural logarithm, and values below 1 / SMALLEST share bins near zero.
BINS, SMALLEST = 4096, 2.0 ** 40
#: Steps between the ends of a bracket.
STEPS = 1 << 20
LAST_BIN = 2 ** 62


def value_bin(v: Column) -> Column:
    """A bin number that never falls as ``v`` rises; NaN comes last."""
    size = F.floor(F.least(F.log1p(F.abs(v) * SMALLEST), F.lit(1e6)) * BINS)
    return F.when(F.isnan(v), F.lit(LAST_BIN)).when(v < 0, -size).otherwise(size)


def value_bins(df: DataFrame, keys: list[str], value: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per group and bin: n (values), lo, hi, total and var (of the bin's values), and
    aggregates of all its rows in ``extra``; written, so that it is counted once. Rows without
    a value form a bin of their own with n = 0."""
    checkpoint_dir(df.sparkSession)
    v = F.col(value).cast("double")
    return df.withColumn("_bin", value_bin(v)).groupBy(*keys, "_bin").agg(
        F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.sum(v).alias("total"),
        F.var_pop(v).alias("var"), *[c.alias(k) for k, c in (extra or {}).items()]).checkpoint()


def wanted_ranks(counts: DataFrame, keys: list[str], order: list[str], before: Column, ranks: Column) -> DataFrame:
    """Add start (rows of the group below the bracket) and the wanted ranks within it; keep brackets with some."""
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(*order))  # over counts, not rows
    rows = counts.withColumn("start", before + upto - F.col("n"))
    inside = lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n"))
    return rows.withColumn("ranks", F.filter(ranks, inside)).where(F.size("ranks") > 0)


def quantiles_of(df: DataFrame, bins: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group with a column per entry of ``probs``, from ``value_bins`` of ``df``."""
    counts = bins.where(F.col("n") > 0).select(*keys, "_bin", "n", "lo", "hi")
    all_rows = F.sum("n").over(Window.partitionBy(*keys))
    position = lambda p: F.lit(float(p)) * (F.col("_all") - 1)
    ranks = F.array_distinct(F.array(*[f(position(p)).cast("long") for p in probs.values() for f in (F.floor, F.ceil)]))
    found = wanted_ranks(counts.withColumn("_all", all_rows), keys, ["_bin"], F.lit(0), ranks).select(
        *keys, "_all", "_bin", "lo", "hi", "start", "n", "ranks").checkpoint()
    columns = [*keys, "_all", "ranks", "lo"]
    solved, open_ = [found.where("lo <=> hi").select(columns)], found.where("NOT lo <=> hi")
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL").withColumn("_bin", value_bin(F.col("_v")))
    while not open_.isEmpty():
        # a group's bin holds no more open brackets than there are ranks
        brackets = open_.select(*keys, "_bin", "_all", "start", "ranks", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
        within = salted_join(rows, brackets, [*keys, "_bin"], "inner", size_col="n", sizes=counts.select(*keys, "_bin", "n"))
        step = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * STEPS)
        bracket = [*keys, "_bin", "_all", "start", "ranks", "_lo", "_hi"]
        finer = within.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))).groupBy(*bracket, step.alias("_step")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        finer = finer.withColumnsRenamed({"start": "_start", "ranks": "_ranks"})
        found = wanted_ranks(finer, [*keys, "_bin", "_lo"], ["_step"], F.col("_start"), F.col("_ranks")).select(
            *keys, "_all", "_bin", "lo", "hi", "start", "n", "ranks").checkpoint()
        solved.append(found.where("lo <=> hi").select(columns))
        open_ = found.where("NOT lo <=> hi")
    # at most two ranks per entry of ``probs``
    answers = reduce(DataFrame.unionByName, solved).select(*keys, "_all", F.explode("ranks").alias("_rank"), F.col("lo").alias("_x"))
    answers = answers.groupBy(*keys, "_all").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_of"))

    def at(p: float) -> Column:
        low, high = (F.element_at("_of", f(position(p)).cast("long")) for f in (F.floor, F.ceil))
        return low + (position(p) - F.floor(position(p)).cast("long")) * (high - low)

    return answers.select(*keys, *[at(p).alias(name) for name, p in probs.items()])


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group with a column per entry of ``probs`` (name -> p in [0, 1]).
    Nulls are ignored; groups without values do not appear."""
    return quantiles_of(df, value_bins(df, keys, value), keys, value, probs)
