"""Line dedup by the number of distinct sites a line appears on.

A line (trimmed, not blank) that stands on ``SITES`` or more distinct sites is boilerplate. Every document but the one with the smallest doc_id
that has the line loses it, so no text vanishes from the corpus.

Line hashes that occur fewer times than that cannot reach the spread and go first,
by a plain count. Of the others one HyperLogLog sketch of the sites per line merges
by partial aggregation; a hot line sends one sketch per task. Lines whose estimate
is near the threshold (within ``NEAR`` of it) get exact distinct counts, from
distinct (line, site) pairs. Lines are told apart by 64-bit xxHash and length.

Defined cases: a null text has no lines, an empty one is one blank line, and both stay as they are; null source
is no site; blank lines always stay; a document that would lose every line keeps its
text only if another row has the same whole text (whole copies are the business of
document dedup); null doc_id counts as the largest id; rows that share a doc_id never
take a line from each other; an empty table gives an empty result; other columns,
whatever their names, are kept by ``remove_boilerplate`` and otherwise not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelake.llm.common import SPACES, materialize, release_shuffles, text_key

SITES = 10
NEAR = 0.25
#: log2 of the registers of a sketch: a standard error of about 2 percent.
LOG_REGISTERS = 11
NULL_ID = 2 ** 63 - 1


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(_trimmed(line), F.length(_trimmed(line)))


def _counts(line: Column) -> Column:
    """Whether a line is not blank."""
    return _trimmed(line) != ""


def line_sites(docs: DataFrame) -> DataFrame:
    """doc_id, row (key of the text), source, distinct (lines of the document), line (hash):
    one row per distinct line of a document."""
    lines = F.transform(F.filter(F.split("text", "\n"), _counts), _line_hash)
    d = docs.where(F.col("text").isNotNull()).select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), text_key(F.col("text")).alias("row"), "source",
        F.array_distinct(lines).alias("_lines"))
    return d.select("doc_id", "row", "source", F.size("_lines").alias("distinct"), F.explode("_lines").alias("line"))


def boilerplate(spark: SparkSession, occurrences: DataFrame, sites: int = SITES) -> DataFrame:
    """line, keeper (smallest doc_id) of the lines that stand on ``sites`` sites or more."""
    often = occurrences.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keeper")).where(
        F.col("n") >= sites)
    often = materialize(spark, often.select("line", "keeper"), "lines-often")
    seen = materialize(spark, occurrences.join(often, "line").select("line", "source", "keeper"), "lines-seen")
    spread = seen.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("source", F.lit(LOG_REGISTERS))).alias("about"),
        F.first("keeper").alias("keeper"))
    spread = materialize(spark, spread, "lines-spread")
    near = spread.where(F.abs(F.col("about") - sites) <= NEAR * sites)
    exact = seen.join(near.select("line"), "line", "left_semi").select("line", "source", "keeper").distinct().groupBy(
        "line").agg(F.count("source").alias("n"), F.first("keeper").alias("keeper")).where(F.col("n") >= sites)
    sure = spread.where(F.col("about") > sites + NEAR * sites)
    return sure.select("line", "keeper").unionByName(exact.select("line", "keeper"))


def cut_lines(spark: SparkSession, docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``docs`` with new text, and _lines, _removed (lines before, lines cut)."""
    release_shuffles(spark)
    occurrences = materialize(spark, line_sites(docs), "line-sites")
    common = materialize(spark, boilerplate(spark, occurrences, sites), "boilerplate")
    # both sides come from a shuffle, so a line of a third of all documents is split;
    # a document's list is no longer than the document
    lost = occurrences.join(common, "line").where(F.col("doc_id") != F.col("keeper"))
    lost = materialize(spark, lost.groupBy("doc_id", "row").agg(
        F.collect_set("line").alias("_lost"), (F.max("distinct") == F.size(F.collect_set("line"))).alias("emptied")), "lines-lost")
    # whole copies are left to document dedup
    emptied = lost.where("emptied")
    copied = docs.groupBy(text_key(docs["text"]).alias("row")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(
        emptied.select("row").distinct(), "row", "left_semi")
    copied = materialize(spark, copied.select("row", F.lit(True).alias("emptied")), "whole-copies")
    lost = lost.join(copied, ["row", "emptied"], "left_anti").select(
        F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), "_lost")
    d = docs.join(lost, (F.coalesce(docs["doc_id"], F.lit(NULL_ID)) == F.col("_doc")) & (
        text_key(docs["text"]) == F.col("_row")), "left")
    d = d.withColumn("_all", F.split("text", "\n"))
    stays = lambda x: ~(_counts(x) & F.array_contains("_lost", _line_hash(x)))
    d = d.withColumn("_left", F.when(F.col("_lost").isNull(), F.col("_all")).otherwise(F.filter("_all", stays)))
    d = d.withColumn("_lines", F.coalesce(F.size("_all"), F.lit(0))).withColumn("_cut", F.col("_lost").isNotNull())
    d = d.withColumn("_removed", F.when(F.col("_cut"), F.size("_all") - F.size("_left")).otherwise(F.lit(0)))
    text = F.when(F.col("_cut"), F.array_join("_left", "\n")).otherwise(F.col("text"))
    return d.withColumn("text", text).select(*docs.columns, "_lines", "_removed")


def line_dedup(spark: SparkSession, docs: DataFrame, sites: int = SITES) -> DataFrame:
    """doc_id, n_lines, n_removed, text (what is left) per row of ``docs``."""
    cut = cut_lines(spark, docs.select("doc_id", "source", "text"), sites)
    return cut.select("doc_id", F.col("_lines").cast("long").alias("n_lines"),
                      F.col("_removed").cast("long").alias("n_removed"), "text")


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``docs``, all rows and columns, without boilerplate lines."""
    return cut_lines(spark, docs, sites).select(*docs.columns)
