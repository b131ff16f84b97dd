"""Helpers the operators of this subpackage share.

Words are maximal runs of characters other than space and U+0009 to U+000D.
Intermediate tables go to the shared folder of ``spark.checkpoint.dir``, so a
lost executor never takes them away and nothing is computed twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imagelake.session import checkpoint_dir

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


#: Bytes of text a Python worker takes apart at once.
CHUNK_BYTES = 2_000_000


class Recent:
    """A cache of what was used lately: two generations of at most ``size`` entries each, or two
    columns as long as both."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}
        self.columns: tuple[pa.Array, pa.Array] | None = None

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def get_all(self, keys: Iterable) -> dict:
        """Each different key and what is known of it, or None."""
        young = self.young.get
        return {k: self.get(k) if (v := young(k)) is None else v for k in dict.fromkeys(keys)}

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def get_column(self, keys: pa.Array) -> pa.Array:
        """What ``put_column`` kept for each of ``keys`` (strings), as bytes, or null. Columns take
        a fraction of the memory and time of as many objects."""
        if self.columns is None:
            return pa.nulls(len(keys), pa.large_binary())
        kept, values = self.columns
        return values.take(pc.index_in(keys, value_set=kept))

    def put_column(self, keys: pa.Array, values: pa.Array) -> None:
        """Keep the values of different keys, and of those kept before the latest that have room
        beside them in twice ``size``."""
        n = 2 * self.size
        keys, values = keys[:n], values[:n]
        if self.columns is not None:
            before = pc.invert(pc.is_in(self.columns[0], value_set=keys))
            keys, values = (pa.concat_arrays([new, old.filter(before)[:n - len(new)]]) for new, old in zip((keys, values), self.columns))
        self.columns = keys, values


@lru_cache(maxsize=1)
def worker_caches(owner: str, *sizes: int) -> tuple[Recent, ...]:
    """Caches of a Python worker, kept for all its tasks of one owner. Another owner's
    take their place, so that a worker never holds those of two stages."""
    return tuple(Recent(n) for n in sizes)


def text_chunks(texts: Iterable[bytes | None], size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The texts in order (null as empty), in lists of about ``size`` bytes."""
    chunk, n = [], 0
    for text in texts:
        chunk.append(text or b"")
        n += len(chunk[-1])
        if n >= size:
            yield chunk
            chunk, n = [], 0
    if chunk:
        yield chunk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    t = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def text_key(text: Column) -> Column:
    """64-bit hash of a text. With doc_id it tells rows of one id, or of none, apart; rows
    equal in both are equal to the operators."""
    return F.xxhash64(text, F.length(text))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends
    here, and a lost executor costs no recomputation of what lies before."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of a query when that query ends. The
    operators write their intermediate results as tables, so those files are of
    no further use, and at scale they would fill the disks until the driver's
    garbage collector happens to run."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def width(spark: SparkSession) -> int:
    """Shuffle width the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pow2_at_least(x: float) -> int:
    return 1 << max(0, int(x - 1).bit_length()) if x > 1 else 1


def running_totals(spark: SparkSession, df: DataFrame, order: list[str], sums: dict[str, str],
                   label: str, parts: int | None = None) -> DataFrame:
    """Add running totals over a global order; no task sees more than one range.

    ``order`` must be a total order up to interchangeable rows. ``sums`` maps a new
    column to the column it totals (inclusive). The rows are range-partitioned and
    sorted, and written with the number of their range, so that number is part of
    the data. The totals of the ranges (one row per range) give each range's start.
    """
    parts = parts or width(spark)
    t = materialize(spark, df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("_range", F.spark_partition_id()), label)
    totals = t.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    by_range = Window.orderBy("_range")
    starts = totals.select("_range", *[
        (F.sum(f"_t_{n}").over(by_range) - F.col(f"_t_{n}")).alias(f"_s_{n}") for n in sums])
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = t.select("*", *[F.sum(c).over(within).alias(f"_w_{n}") for n, c in sums.items()])
    return (own.join(F.broadcast(starts), "_range")  # one row per range
            .select(*df.columns, *[(F.col(f"_s_{n}") + F.col(f"_w_{n}")).alias(n) for n in sums]))


def split_join(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int,
               share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per ``key``, ``size`` rows each)
    that a hot key cannot skew.

    Keys with at least 1/``share`` of all ``total`` rows number ``share`` at most; their
    group rows are broadcast, so their rows are joined where they lie. All other
    rows meet in a shuffled join, in which no key has more than that share.
    """
    least = max(2, -(-total // share))
    cols = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) >= least)
    near = rows.join(F.broadcast(hot), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(
        groups.where(F.col(size) < least), key)
    keep = [*rows.columns, *cols]
    return near.select(*keep).unionByName(far.select(*keep))
