"""Resolve requests to landed pictures (A6) and read the prediction log.

Instead of one HTTP GET per request, the landing area is read in bulk, restricted to
the ``upload_date`` partitions that the requests mention (``landed_for``), in two
phases: ``newest_landed`` finds the newest picture of each key without reading a pixel,
``fetch_pixels`` then reads those that are wanted. ``image_fetch`` joins requests to
what was found. A missing object is an ``error='not found'`` row, never a dropped one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keyfilter import key_filter
from ..sinks.compaction import newest_manifest, read_log


def image_fetch(requests: DataFrame, images: DataFrame, key="object_key") -> DataFrame:
    """Left join of requests to pictures on ``key`` (a column or a list); adds
    ``fetch_error``. Both sides are shuffled for this join, so when many requests
    name one picture, adaptive execution splits that skewed partition of the
    request side and replicates the picture's partition (skew join)."""
    keys = [key] if isinstance(key, str) else list(key)
    j = requests.join(images.withColumn("_found", F.lit(True)), keys, "left")
    return j.withColumn("fetch_error", F.when(F.col("_found").isNull(), F.lit("not found"))).drop("_found")


MAX_DATES = 1000  # dates named one by one in a filter; beyond it their range


def landed_for(requests: DataFrame, landed: DataFrame, date_col: str = "upload_date") -> DataFrame:
    """The landing table restricted to the dates the requests mention (a null date is none):
    at most ``MAX_DATES`` + 1 dates come back to the driver, and as literals they prune the landing
    table's ``upload_date`` partitions at planning time. The join on the key is exact."""
    named = [r[0] for r in requests.select(date_col).where(F.col(date_col).isNotNull()).distinct().limit(MAX_DATES + 1).collect()]
    if len(named) <= MAX_DATES:
        return landed.where(F.col(date_col).isin(named))
    lo, hi = requests.agg(F.min(date_col), F.max(date_col)).first()
    return landed.where(F.col(date_col).between(F.lit(lo), F.lit(hi)))


def newest_landed(landed: DataFrame, keys: DataFrame, on: list[str], columns: list[str], time_col: str = "uploaded_at") -> DataFrame:
    """``columns`` (no pixels) and time of the newest picture of each of ``keys``: a Bloom filter of
    the keys drops other pictures in the scan, so only narrow rows of matched ones are shuffled."""
    order = F.col(time_col) if time_col in landed.columns else F.lit(0)
    near = key_filter(landed, keys, on).select(*on, *columns, order.alias("_landed_at"))
    newest = near.groupBy(*on).agg(F.max(F.struct("_landed_at", *columns)).alias("_m"))
    return newest.join(keys, on, "left_semi").select(*on, "_m.*")


def fetch_pixels(landed: DataFrame, chosen: DataFrame, on: list[str], time_col: str = "uploaded_at") -> DataFrame:
    """``pixels`` of the ``chosen`` pictures (``on``, _landed_at), one row each. Pixels of
    pictures that no chosen key can mean are dropped in the scan, before the shuffle."""
    order = F.col(time_col) if time_col in landed.columns else F.lit(0)
    near = key_filter(landed, chosen, on).select(*on, order.alias("_at"), "pixels")
    met = near.join(chosen.select(*on, "_landed_at"), on).where(F.col("_at").eqNullSafe(F.col("_landed_at")))
    # pictures of one key and instant: the same one in every run
    return met.groupBy(*on).agg(F.max_by("pixels", F.xxhash64("pixels")).alias("pixels"))


def predictions_scan(spark: SparkSession, path: str | None = None, jdbc: dict | None = None,
                     session_id: str | None = None, num_partitions: int = 8,
                     predicate=None) -> DataFrame:
    """Read the prediction log from Parquet (a compacted log through its manifest) or JDBC (A7). For JDBC the read is split
    on ``partitionColumn`` bounds when given (``lowerBound``/``upperBound`` in
    ``jdbc``); the session filter and ``predicate`` are pushed to the source."""
    if jdbc is not None:
        opts = dict(jdbc)
        r = spark.read.format("jdbc").options(**opts)
        if "partitionColumn" in opts:
            r = r.option("numPartitions", str(num_partitions))
        df = r.load()
    else:
        df = read_log(spark, path) if newest_manifest(spark, path)["version"] else spark.read.parquet(path)
    if session_id is not None:
        df = df.where(F.col("session_id") == session_id)
    if predicate is not None:
        df = df.where(predicate)
    return df
