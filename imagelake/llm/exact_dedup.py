"""Exact deduplication over a persistent digest index (JVM functions only).

The index is a table of the SHA-256 digests of all texts kept so far, bucketed and
sorted by digest. New data is grouped by digest first, so that a group of copies
of any size crosses the shuffle as one row per task. What the index does not hold
is found by a sort-merge anti-join, in which the index side is read bucket by
bucket without a shuffle, and appended.

Defined cases: null text counts as empty; in a group of copies the largest doc_id
stays (null ids stay only where a group has no other); rows that repeat a doc_id
share its verdict; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelake.llm.common import materialize, scratch_path, split_join, width


def text_digests(docs: DataFrame) -> DataFrame:
    """doc_id and the binary SHA-256 of the whole text."""
    return docs.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))


class DigestIndex:
    """A digest index at ``location`` (shared storage), registered as table ``name``.

    An index that is already there is opened again; ``buckets`` must then be the
    number it was made with. Choose it for the final size (about 256 MB a bucket).
    """

    def __init__(self, spark: SparkSession, name: str, location: str, buckets: int):
        self.spark, self.name, self.buckets = spark, name, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame) -> DataFrame:
        """Append the digests that ``docs`` brings and judge each of its rows:
        doc_id, keep_id (the row that stays, maybe of earlier data), group_size
        (copies in ``docs``), kept, digest.

        A rerun after a failure finds its own digests in the index and returns the
        same verdicts, since a kept row is its own ``keep_id``."""
        spark = self.spark
        rows = materialize(spark, text_digests(docs), "digests")
        groups = materialize(spark, rows.groupBy("digest").agg(
            F.max("doc_id").alias("new_id"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
        fresh = groups.hint("merge").join(self.read(), "digest", "left_anti")
        (fresh.select("digest", F.col("new_id").alias("keep_id"))
         .repartition(self.buckets, "digest")
         .write.mode("append").insertInto(self.name))
        known = groups.hint("merge").join(self.read(), "digest")
        verdicts = materialize(spark, known.select("digest", "keep_id", "group_size"), "digest-verdicts")
        return split_join(rows, verdicts, "digest", "group_size", rows.count()).select(
            "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def exact_dedup(spark: SparkSession, docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Judge ``docs`` against a new index of their own (see :class:`DigestIndex`)."""
    path = scratch_path(spark, "digest-index")
    name = "digest_index_" + path.rsplit("-", 1)[1]
    return DigestIndex(spark, name, path, buckets or width(spark)).add(docs)
