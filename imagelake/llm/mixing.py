"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled (by MD5 of seed and id) and stand in line,
again and again up to ``MAX_EPOCHS`` times. A copy of a document finishes at virtual
time (words of its source up to its end) / (weight of its source). All copies are
sorted by that time over the whole corpus, and the line is cut at the total budget:
the sources then have been served in proportion to their weights, and a source
that ran out has left its share to the others.

The running sums never pass through one task: within a source they are taken per
(source, leading digits of the MD5), with the sums of those buckets as starts, and
over the whole line per range of the sort (``running_totals``). Only what has one
row per source, per bucket or per range is summed in a plain window.

Defined cases: null text has size 0; null source is the last source; rows that
share doc_id, source and text are taken together, equally often, and each is returned
with its own size; rows of a null doc_id are told apart by their texts; documents of size 0 are taken 0 times; an empty table gives an
empty result; other columns, whatever their names, are not read. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imagelake.llm.common import materialize, running_totals, text_key, words

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
#: Documents per bucket of the shuffled order, about.
BUCKET_ROWS = 4000


def _key(source: Column) -> Column:
    """Source as a key that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("t"))


def shuffled(spark: SparkSession, docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, source, row (key of the text), rows (equal in all three), skey, size (of all these
    rows), place (shuffled order) and source_words (of the source up to the end of these)."""
    units = docs.select("doc_id", "source", text_key(F.col("text")).alias("row"), F.size(words(F.col("text"))).cast("long").alias("size")) \
        .groupBy("doc_id", "source", "row").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    place = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    units = materialize(spark, units.select("*", _key(F.col("source")).alias("skey"), place.alias("place"),
                                             F.lpad(F.hex("row"), 16, "0").alias("tie")), "mix-units")
    digits = 1
    n = units.count()
    while 16 ** digits * BUCKET_ROWS < n:
        digits += 1
    # rows without id share one place; their buckets, after those before it, go on by text
    no_id = F.md5(F.lit(seed + ":"))
    units = units.withColumn("_bucket", F.concat(F.substring("place", 1, digits), F.when(
        F.col("doc_id").isNull(), F.concat(F.lit("m"), F.substring("tie", 1, digits))).when(
        F.col("place") > no_id, F.lit("z")).otherwise(F.lit(""))))
    by_source = Window.partitionBy("skey").orderBy("_bucket")  # one row per bucket of a source
    starts = units.groupBy("skey", "_bucket").agg(F.sum("size").alias("_n")).select(
        "skey", "_bucket", (F.sum("_n").over(by_source) - F.col("_n")).alias("_start"))
    own = F.sum("size").over(Window.partitionBy("skey", "_bucket").orderBy("place", "doc_id", "tie")
                             .rowsBetween(Window.unboundedPreceding, 0))
    return materialize(spark, units.select("*", own.alias("_own")).join(starts, ["skey", "_bucket"]).select(
        "doc_id", "source", "row", "rows", "skey", "size", "place", (F.col("_start") + F.col("_own")).alias("source_words")), "mix-line")


def targets(spark: SparkSession, line: DataFrame) -> DataFrame:
    """skey, weight, source_size, target (one row per source) of a shuffled line.

    A target is the source's share of all words by weight, at most MAX_EPOCHS times
    its size, the excess shared by the others. In order of cap / weight, a source is
    full if the water level at which it fills needs no more than all words."""
    sources = line.groupBy("skey").agg(F.sum("size").alias("source_size"), F.max("size").alias("longest"))
    one = F.lit(1).cast("long")
    ranked = running_totals(spark, sources.withColumn("_one", one), ["skey"], {"_rank": "_one"}, "mix-ranks")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("_rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size") * MAX_EPOCHS
    ranked = ranked.select("skey", "source_size", "longest", weight.cast("long").alias("weight"), cap.alias("cap"))
    filled = running_totals(spark, ranked.withColumn("level", F.col("cap") / F.col("weight")), ["level", "skey"],
                            {"caps": "cap", "weights": "weight"}, "mix-levels")
    budget, all_weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    needs = (F.col("caps") - F.col("cap")) + F.col("level") * (
        F.lit(all_weights) - (F.col("weights") - F.col("weight")))
    filled = filled.withColumn("full", needs <= F.lit(budget).cast("double"))
    caps, weights = filled.agg(F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)),
                               F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight")))).first()
    level = (budget - caps) / weights if weights else 0.0
    return filled.select("skey", "weight", "source_size", "longest", F.when(F.col("full"), F.col("cap").cast("double"))
                         .otherwise(F.col("weight") * F.lit(float(level))).alias("target"))


def mixed_line(spark: SparkSession, docs: DataFrame, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """The mix as its copies in order (doc_id, source, row, epoch, size, finish, end: words
    of the mix up to its end), and the documents with their source's size and target."""
    line = shuffled(spark, docs, seed)
    if line.isEmpty():
        empty = line.withColumns({"source_size": F.lit(0).cast("long"), "target": F.lit(0.0)})
        return line.select("doc_id", "source", "row", F.lit(0).alias("epoch"), "size", F.lit(0.0).alias("finish"),
                           F.lit(0).cast("long").alias("end")), empty
    by_source = materialize(spark, targets(spark, line), "mix-targets")
    budget, slack = by_source.agg(F.sum("source_size"), 2 * F.sum("longest")).first()
    units = line.join(by_source, "skey")
    # a copy that starts beyond its target by more than all sources can lag behind
    # is past the cut for certain
    before = F.col("epoch") * F.col("source_size") + F.col("source_words") - F.col("size")
    copies = (units.where(F.col("size") > 0)
              .withColumn("epoch", F.explode(F.array(*map(F.lit, range(MAX_EPOCHS)))))
              .where(before < F.col("target") + F.lit(slack))
              .select("doc_id", "source", "row", "skey", "place", "epoch", "size",
                      ((before + F.col("size")) / F.col("weight")).alias("finish")))
    queue = running_totals(spark, copies, ["finish", "skey", "place", "doc_id", "row", "epoch"], {"end": "size"}, "mix-queue")
    return queue.where(F.col("end") <= F.lit(budget)).select("doc_id", "source", "row", "epoch", "size", "finish", "end"), units


def unit_counts(spark: SparkSession, docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, row, rows (equal rows), size (of one of them), source_size, target and
    copies (times the mix takes each)."""
    mix, units = mixed_line(spark, docs, seed)
    copies = mix.groupBy("doc_id", _key(F.col("source")).alias("skey"), "row").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.withColumnsRenamed({"doc_id": "_doc", "skey": "_skey", "row": "_row"})
    n = F.coalesce("copies", F.lit(0).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("skey") == F.col("_skey")) & (F.col("row") == F.col("_row"))
    return units.join(copies, same, "left").select(
        "doc_id", "source", "row", "rows", F.expr("size DIV rows").alias("size"), "source_size", "target", n.alias("copies"))


def mix_counts(spark: SparkSession, docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, copies (times taken), taken (words), row
    per row of ``docs``."""
    each = unit_counts(spark, docs, seed).withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return each.select("doc_id", "source", "size", "source_size", "target", "copies",
                       (F.col("size") * F.col("copies")).alias("taken"), "row")


def mix_documents(spark: SparkSession, docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    take = unit_counts(spark, docs, seed).where("copies > 0").select(
        F.col("doc_id").alias("_doc"), _key(F.col("source")).alias("_skey"), F.col("row").alias("_row"), F.col("copies").alias("_copies"))
    rows = docs.join(materialize(spark, take, "mix-take"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (
        _key(F.col("source")) == F.col("_skey")) & (text_key(docs["text"]) == F.col("_row")))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        *[docs[c] for c in docs.columns])
