"""Class-score column functions (E3, E5, softmax)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def softmax(scores) -> Column:
    """exp(s - max) / sum: probabilities from raw scores."""
    s = _c(scores)
    m = F.array_max(s)
    e = F.transform(s, lambda x: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def argmax(probs) -> Column:
    """0-based index of the first maximum."""
    p = _c(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def argmax_confidence(df: DataFrame, probs: str = "probs") -> DataFrame:
    """Add ``class_id`` (first maximum) and ``confidence`` (its value)."""
    return df.withColumn("class_id", argmax(probs)).withColumn(
        "confidence", F.array_max(F.col(probs)).cast("double"))


def topk(df: DataFrame, scores: str = "scores", k: int = 5) -> DataFrame:
    """Top ``k`` classes per row (E5): one output row per (row, rank) with
    ``rank`` (1-based), ``class_id`` and ``score``; score descending, class id
    ascending on ties. Sorting happens inside each row's array."""
    keyed = F.transform(_c(scores), lambda s, i: F.struct(
        (-s).alias("neg"), i.cast("int").alias("class_id"), s.alias("score")))
    best = F.slice(F.array_sort(keyed), 1, k)
    others = [c for c in df.columns if c != scores]
    return df.select(*others, F.posexplode(best).alias("_pos", "_t")).select(
        *others, (F.col("_pos") + 1).cast("int").alias("rank"),
        F.col("_t.class_id").alias("class_id"), F.col("_t.score").alias("score"))
