"""Hard negatives for contrastive training: pair scores in a secondary-sort shuffle.

An anchor's positives are its best rows of the same label, its negatives rows of other
labels that score close below a positive: at ``low`` to ``high`` percent of its score.

1. Scores are exact integer inner products of quantised vectors (``floor(scale * x)``).
   Anchors are taken in blocks of about ``ANCHOR_BLOCK``; a block is broadcast, and every task
   scores its rows against it as matrix products. No row is shuffled for that.
2. Each task keeps, per anchor, its best ``positives`` rows of the anchor's label. Of
   those the best of all tasks open the windows.
3. Each task keeps, per window, its best ``negatives`` rows. What any task keeps
   contains what the whole table would, so nothing is lost, and a task sends no more
   rows for an anchor than its windows hold, whatever the table's size.
4. Kept pairs become keys of (anchor, descending score, positives first, id), packed as
   bytes that sort in that order. ``repartitionAndSortWithinPartitions`` brings an
   anchor together, sorted; an iterator reads it as a stream, opens a window at each positive
   and emits negatives while windows are open. It holds the open windows of one
   anchor, never its pairs.

Defined cases: rows with a null label, a null vector, or a null or non-finite number take
no part; vectors of different lengths count as followed by zeros; a null vec_id counts as the
largest id and is no anchor; rows that share a vec_id are rows (and anchors) of their own; of equal
scores the smaller vec_id comes first; scores beyond +-2**62 are held there; an
empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imagelake.llm.common import materialize, scratch_path, width
from imagelake.llm.vectors import matrix, whole_vectors

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
SCALE = 256
ANCHOR_BLOCK = 4_096
#: Anchors and rows scored at once.
STEP_ANCHORS, STEP_ROWS = 512, 2_048
NULL_ID = 2 ** 63 - 1
TOP = 2 ** 62
#: Score of a pair that does not count.
NONE = -TOP - 1
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: anchor id, anchor row, descending score, 0 for a positive, id, row
KEY = struct.Struct(">QQQBQQ")
_SHIFT = 2 ** 63


def packed_key(anchor: int, anchor_row: int, score: int, is_negative: int, other: int, other_row: int) -> bytes:
    """Bytes that sort by anchor, then descending score, positives first, then id."""
    return KEY.pack(anchor + _SHIFT, anchor_row, TOP - score, is_negative, other + _SHIFT, other_row)


def quantised(vectors: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    """row (number), vec_id, label, anchor, q (packed float64 integers) of the rows that take part."""

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                found = [None if v is None else np.floor(scale * v) for v in whole_vectors(batch.column("embedding"))]
            packed = [None if q is None else np.clip(q, -1e300, 1e300).tobytes() for q in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "anchor")),
                                              pa.array(packed, pa.binary())], ["vec_id", "label", "anchor", "q"])

    rows = vectors.where(F.col("label").isNotNull()).select(
        F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor & F.col("vec_id").isNotNull(), F.lit(False)).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.mapInArrow(quantise, "vec_id long, label long, anchor boolean, q binary").where("q IS NOT NULL")
    return rows.withColumn("row", F.monotonically_increasing_id())


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` and ``b`` (whole numbers as float64),
    held within +-TOP."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)  # every partial sum is exact
    if most < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [[int(x) for x in row] for row in b]
    return np.array([[max(-TOP, min(TOP, sum(int(x) * y for x, y in zip(row, other)))) for other in whole]
                     for row in a], np.int64).reshape(len(a), len(b))


def firsts(scores: np.ndarray, count: int) -> np.ndarray:
    """Columns of the ``count`` highest scores per row (all, if fewer); of equal scores
    the first columns."""
    if scores.shape[1] <= count:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    at = scores.shape[1] - count
    least = np.partition(scores, at, axis=1)[:, at][:, None]
    above, equal = scores > least, scores == least
    wanted = count - above.sum(1)
    chosen = above | (equal & (np.cumsum(equal, axis=1) <= wanted[:, None]))
    return np.nonzero(chosen)[1].reshape(len(scores), count)


class Best:
    """The ``count`` best (score, id, row) of each of ``n`` groups, as far as they were seen."""

    def __init__(self, n: int, count: int):
        self.score = np.full((n, count), NONE)
        self.id, self.row = np.full((n, count), NULL_ID), np.full((n, count), NULL_ID)

    def add(self, groups: slice, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores of the groups with rows sorted by (id, row); NONE for those that don't count."""
        count = self.score.shape[1]
        at = firsts(scores, count)
        mine = [self.score[groups], self.id[groups], self.row[groups]]
        new = [np.take_along_axis(scores, at, 1), ids[at], rows[at]]
        score, id_, row = (np.concatenate(x, 1) for x in zip(mine, new))
        order = np.lexsort((row, id_, -score), axis=1)[:, :count]
        for kept, x in zip((self.score, self.id, self.row), (score, id_, row)):
            kept[groups] = np.take_along_axis(x, order, 1)


@dataclass(frozen=True)
class Anchors:
    """A block of anchors, and per anchor the score bounds of its windows (none at first)."""
    id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    q: np.ndarray
    low: np.ndarray
    high: np.ndarray


def scored(batches: Iterator[pa.RecordBatch], anchors: Anchors):
    """(slice of anchors, scores, ids, rows, equal labels) of all rows, in pieces, rows sorted by (id, row)."""
    for batch in batches:
        for part in (batch.slice(i, STEP_ROWS) for i in range(0, batch.num_rows, STEP_ROWS)):
            ids, rows, labels = (part.column(c).to_numpy() for c in ("vec_id", "row", "label"))
            order = np.lexsort((rows, ids))
            q = matrix(part.column("q").to_pylist(), anchors.q.shape[1])[order]
            ids, rows, labels = ids[order], rows[order], labels[order]
            for lo in range(0, len(anchors.id), STEP_ANCHORS):
                some = slice(lo, lo + STEP_ANCHORS)
                yield some, exact_scores(anchors.q[some], q), ids, rows, anchors.label[some][:, None] == labels


def best_positives(table: DataFrame, shared: Broadcast, count: int) -> DataFrame:
    """nth (place of the anchor in its block), score, id, row: each task's best of the anchor's label."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best = Best(len(anchors.id), count)
        for some, scores, ids, rows, same in scored(batches, anchors):
            best.add(some, np.where(same & (anchors.row[some][:, None] != rows), scores, NONE), ids, rows)
        nth, place = np.nonzero(best.score != NONE)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            nth, best.score[nth, place], best.id[nth, place], best.row[nth, place])], ["nth", "score", "id", "row"])

    return table.select("vec_id", "row", "label", "q").mapInArrow(search, "nth long, score long, id long, row long")


def window_negatives(table: DataFrame, shared: Broadcast, count: int) -> DataFrame:
    """key: packed keys of each task's best negatives of every window, one per pair."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        n, windows = anchors.low.shape
        best = [Best(n, count) for _ in range(windows)]
        for some, scores, ids, rows, same in scored(batches, anchors):
            for w in range(windows):
                inside = ~same & (scores >= anchors.low[some, w, None]) & (scores <= anchors.high[some, w, None])
                if inside.any():
                    best[w].add(some, np.where(inside, scores, NONE), ids, rows)
        score, id_, row = (np.concatenate([getattr(b, c) for b in best], 1) for c in ("score", "id", "row"))
        for nth in range(n):
            kept = np.flatnonzero(score[nth] != NONE)
            keys = {packed_key(int(anchors.id[nth]), int(anchors.row[nth]), s, 1, i, r) for s, i, r in zip(
                score[nth, kept].tolist(), id_[nth, kept].tolist(), row[nth, kept].tolist())}
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.binary())], ["key"])

    return table.select("vec_id", "row", "label", "q").mapInArrow(search, "key binary")


def mined(keys: Iterator[tuple[bytes, None]], positives: int, negatives: int, low: int, high: int):
    """Rows of MINED from an anchor's keys in order."""
    now, windows = None, []
    for key, _ in keys:
        anchor, anchor_row, place, is_negative, other, _ = KEY.unpack(key)
        if (anchor, anchor_row) != now:
            now, windows, opened = (anchor, anchor_row), [], 0
        score = TOP - place
        if not is_negative:
            if opened < positives:
                windows.append([other - _SHIFT, score, 0])
                opened += 1
            continue
        for w in windows:
            if w[2] < negatives and low * w[1] <= 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor - _SHIFT, w[0], w[2], other - _SHIFT, w[1], score
        windows = [w for w in windows if w[2] < negatives and 100 * score >= low * w[1]]


def write_keys(spark: SparkSession, table: DataFrame, mine: DataFrame, columns: int, path: str, positives: int,
               negatives: int, low: int, high: int) -> None:
    """Append the keys of a block of anchors (``mine``, about ANCHOR_BLOCK rows of ``table``)."""
    got = mine.select("vec_id", "row", "label", "q").toArrow()
    none = np.zeros((got.num_rows, 0), np.int64)
    anchors = Anchors(*(got.column(c).to_numpy() for c in ("vec_id", "row", "label")),
                      matrix(got.column("q").to_pylist(), columns), none, none)
    shared = spark.sparkContext.broadcast(anchors)  # about ANCHOR_BLOCK vectors
    first = F.row_number().over(Window.partitionBy("nth").orderBy(F.desc("score"), "id", "row"))
    found = best_positives(table, shared, positives).withColumn("place", first)
    found = found.where(F.col("place") <= positives).toArrow()  # as many per anchor
    shared.destroy()
    opened, bounds = [], np.zeros((2, got.num_rows, positives), np.int64)
    bounds[0] += 1  # a window that is not there is empty
    for nth, score, other, other_row, place in zip(*(c.to_pylist() for c in found.columns)):
        opened.append((packed_key(int(anchors.id[nth]), int(anchors.row[nth]), score, 0, other, other_row),))
        bounds[:, nth, place - 1] = -(-low * score // 100), high * score // 100
    shared = spark.sparkContext.broadcast(replace(anchors, low=bounds[0], high=bounds[1]))
    keys = window_negatives(table, shared, negatives).unionByName(spark.createDataFrame(opened, "key binary"))
    keys.write.mode("append").parquet(path)
    shared.destroy()


def hard_negatives(spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """MINED rows: per anchor and positive the first ``negatives`` rows of other labels whose
    score is ``low`` to ``high`` percent of the positive's."""
    table = materialize(spark, quantised(vectors, is_anchor, scale), "negatives-rows")
    size = table.agg(F.count(F.when(F.col("anchor"), 1)).alias("anchors"), F.max(F.octet_length("q")).alias("bytes")).first()
    columns, blocks = (size["bytes"] or 0) // 8, -(-size["anchors"] // ANCHOR_BLOCK)
    path = scratch_path(spark, "negatives-keys")
    spark.createDataFrame([], "key binary").write.parquet(path)
    for block in range(blocks):
        mine = table.where(F.col("anchor") & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == block))
        write_keys(spark, table, mine, columns, path, positives, negatives, low, high)
    keys = spark.read.schema("key binary").parquet(path)
    parts = width(spark)
    pairs = keys.rdd.map(lambda r: (bytes(r["key"]), None))
    # the first 16 bytes are the anchor
    together = pairs.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:16]) % parts)
    rows = spark.createDataFrame(together.mapPartitions(lambda it: mined(it, positives, negatives, low, high)), MINED,
                                 verifySchema=False)
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return materialize(spark, rows, "hard-negatives").select(
        "anchor_id", back("positive_id"), "rank", back("negative_id"), "positive_score", "negative_score")
