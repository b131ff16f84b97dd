"""Filter interaction audit: every order of five filters, by a recursive CTE over mask cells.

1. Masks. One pass over the whole texts gives each document five bits, one per filter
   that it fails. Whether a text is a copy needs the whole table: documents are grouped
   by the SHA-256 of their text, and the join back splits hot groups of copies.
2. Cells. Documents become counts per part and mask (32 masks a part at most), with
   the counts of those labelled good and toxic. From here on nothing grows with the
   documents.
3. Effects. Per part, set of filters applied before and filter applied now, the cells
   say how many documents stay, go, or fail a filter but went before.
4. Orders. A recursive CTE extends each prefix by the letters not in it: it joins the
   part's cells on the bits applied so far, adds the letter's bit, and emits the
   metrics of that step. Each prefix is evaluated once, though up to 24 orders share
   it; an order's steps are its prefixes.

A filter's Shapley count adds what it removes over all orders: a prefix of k letters
starts (5 - k)! of them.

Defined cases: null text counts as empty, null source as part ''; a null doc_id counts
as the largest id; rows that share a doc_id, or have none, are not copies of each other;
a document is good (toxic) if any label row of its id says so, null labels and ids say
nothing; an empty table gives an empty result; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelake.llm.common import materialize, split_join

LETTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
MIN_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
SYMBOLS = b"#$%&*|"
_UPPER = bytes(range(65, 91))
_FOLLOWING = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point
NULL_ID = 2 ** 63 - 1
METRICS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def own_mask(text: bytes) -> int:
    """Bits of the filters that a text fails by itself (A to D)."""
    words = text.split()  # bytes split at space and U+0009 to U+000D only
    mask = BIT["A"] * (len(words) < MIN_WORDS)
    mask |= BIT["B"] * (100 * len(set(words)) < DISTINCT_PERCENT * len(words))
    upper = len(text) - len(text.translate(None, _UPPER))
    mask |= BIT["C"] * (100 * upper > UPPER_PERCENT * len(text.translate(None, _FOLLOWING)))
    return mask | BIT["D"] * (len(text.translate(None, SYMBOLS)) < len(text))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (of A to D), digest of the text per row of ``docs``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column("text").cast(pa.binary()):
                text = value.as_py() or b""
                masks.append(own_mask(text))
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                ["doc_id", "part", "mask", "digest"])

    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    return rows.mapInArrow(judge, "doc_id long, part string, mask int, digest binary")


def masks(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (of all five filters) per row of ``docs``."""
    rows = materialize(spark, judged(docs), "audit-rows")
    number = F.coalesce("doc_id", F.lit(NULL_ID))
    groups = materialize(spark, rows.groupBy("digest").agg(
        F.min(number).alias("least"), F.count(F.lit(1)).alias("size")), "audit-texts")
    met = split_join(rows, groups, "digest", "size", rows.count())
    copy = F.when(number > F.col("least"), F.lit(BIT["E"])).otherwise(F.lit(0))
    return met.select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def cells(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents per part and mask."""
    rows = materialize(spark, masks(spark, docs), "audit-masks")
    marked = labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
                                          F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic"))
    marked = marked.where((F.col("is_good") == 1) | (F.col("is_toxic") == 1))
    known = rows.join(marked, "doc_id").groupBy("part", "mask").agg(
        F.sum("is_good").alias("good"), F.sum("is_toxic").alias("toxic"))
    counts = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n")).join(known, ["part", "mask"], "left")
    return counts.select("part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"),
                         F.coalesce("toxic", F.lit(0)).alias("toxic"))


def effects(cells: DataFrame) -> DataFrame:
    """part, applied (bits of the filters before), letter, bit, and METRICS: what applying
    the letter's filter after those does to the part."""
    steps = ", ".join(f"named_struct('applied', {s}, 'letter', '{x}', 'bit', {b})"
                      for s in range(1 << len(LETTERS)) for x, b in BIT.items() if not s & b)
    met = cells.select("*", F.expr(f"inline(array({steps}))"))
    mask, before, bit = F.col("mask"), F.col("applied"), F.col("bit")
    alive, fails = mask.bitwiseAND(before) == 0, mask.bitwiseAND(bit) != 0
    total = lambda where, c: F.sum(F.when(where, F.col(c)).otherwise(0)).cast("long")
    return met.groupBy("part", "applied", "letter", "bit").agg(
        total(alive & ~fails, "n").alias("kept"), total(alive & fails, "n").alias("removed"),
        total(~alive & fails, "n").alias("redundant"), total(mask == bit, "n").alias("unique_fails"),
        total(alive & fails, "good").alias("good_lost"), total(alive & fails, "toxic").alias("toxic_lost"))


WALK = f"""
WITH RECURSIVE walk AS (
  SELECT DISTINCT part, '' AS prefix, 0 AS applied, 0 AS step, '' AS letter,
    {', '.join(f'0L AS {m}' for m in METRICS)}
  FROM {{effects}}
  UNION ALL
  SELECT e.part, concat(w.prefix, e.letter), w.applied | e.bit, w.step + 1, e.letter,
    {', '.join(f'e.{m}' for m in METRICS)}
  FROM walk w JOIN {{effects}} e ON e.part = w.part AND e.applied = w.applied
)
SELECT part, prefix, step, letter, {', '.join(METRICS)} FROM walk WHERE step > 0
"""


def prefixes(spark: SparkSession, effects: DataFrame) -> DataFrame:
    """part, prefix, step, letter and METRICS of every prefix of every order (325 a part)."""
    limit = "spark.sql.cteRecursionRowLimit"  # the rows grow with the parts, not with the depth
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return materialize(spark, spark.sql(WALK, effects=effects), "audit-prefixes")
    finally:
        spark.conf.set(limit, before)


def filter_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, METRICS and shapley: one row per part, order of the
    filters and step, zeros included."""
    of_part = materialize(spark, effects(materialize(spark, cells(spark, docs, labels), "audit-cells")), "audit-effects")
    walked = prefixes(spark, of_part)
    starts = F.element_at(F.array(*[F.lit(math.factorial(len(LETTERS) - k)) for k in range(1, len(LETTERS) + 1)]), F.col("step"))
    shapley = walked.groupBy("part", "letter").agg(F.sum(F.col("removed") * starts).alias("shapley"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")
    orders = walked.where(F.col("step") == len(LETTERS)).select("part", F.col("prefix").alias("filter_order"), steps)
    orders = orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    return orders.join(walked, ["part", "prefix", "step"]).join(shapley, ["part", "letter"]).select(
        "part", "filter_order", "step", *METRICS, "shapley")
