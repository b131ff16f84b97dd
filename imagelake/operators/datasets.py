"""Dataset catalogue and statistics (A1 core, H1-H4).

All statistics are partial aggregates; the only window (H2's share) runs over
the aggregate, which holds one row per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import parent_dir, parent_name


def catalog_from_paths(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``label``: the parent folder name of each picture path (A1)."""
    return df.withColumn("label", parent_name(path_col))


def folder_counts(catalog: DataFrame, path_col: str = "path") -> DataFrame:
    """Files per directory (H1)."""
    return catalog.groupBy(parent_dir(path_col).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"))


def split_stats(catalog: DataFrame) -> DataFrame:
    """Pictures, distinct labels and share of all pictures per split (H2)."""
    per = catalog.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_images"), F.count_distinct("label").alias("n_labels"))
    total = F.sum("n_images").over(Window.partitionBy())  # over the 3-row aggregate
    return per.withColumn("share", F.col("n_images") / total)


def one_per_class(df: DataFrame, label_col: str = "label", order_col: str = "path") -> DataFrame:
    """One sample per label (H3): the first path in order, as a bounded aggregate;
    equal paths are told apart by the other columns."""
    others = [c for c in df.columns if c not in (label_col,)]
    first = df.groupBy(label_col).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(order_col, *others)).alias("_s"))
    return first.select(label_col, "_s.*")


def seeded_shuffle(df: DataFrame, key_col: str = "path", seed: int = 0,
                   num_partitions: int | None = None) -> DataFrame:
    """Random but repeatable order (H4): rows are ordered by ``md5(key:seed)``, range
    partitioned and sorted within partitions, so retries give the same order and
    no single task sorts everything."""
    k = F.md5(F.concat(F.col(key_col).cast("string"), F.lit(f":{seed}")))
    keyed = df.withColumn("shuffle_key", k)
    parts = [num_partitions] if num_partitions else []
    return keyed.repartitionByRange(*parts, "shuffle_key").sortWithinPartitions("shuffle_key")
