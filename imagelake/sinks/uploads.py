"""Landing area for uploads (B1): object key, URL and a date-partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land_uploads(df: DataFrame, base_url: str, ts_col: str = "uploaded_at") -> DataFrame:
    """Add ``upload_date`` (yyyyMMdd), ``object_key`` =
    ``uploads/{upload_date}/{session_id}/{filename}`` and ``image_url``."""
    day = F.date_format(F.col(ts_col), "yyyyMMdd")
    key = F.concat_ws("/", F.lit("uploads"), day, F.col("session_id"), F.col("filename"))
    return (df.withColumn("upload_date", day).withColumn("object_key", key)
              .withColumn("image_url", F.concat(F.lit(base_url.rstrip("/") + "/"), key)))


def content_id(df: DataFrame) -> str:
    """Name of a set of rows by its content: the same rows, in any order, have the same name."""
    row = F.xxhash64(*df.columns)
    n, both, total = df.agg(F.count(F.lit(1)), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))).first()
    return f"{n}-{(both or 0) & (2 ** 64 - 1):016x}-{int(total or 0) & (2 ** 64 - 1):016x}"


def write_uploads(df: DataFrame, root: str) -> None:
    """Write landed uploads partitioned by ``upload_date`` (the session id stays a
    column: it has far too many values to be a partition) and ``landing``, the batch's name
    by content. A retry replaces its own partitions and no others, so it leaves equal rows."""
    named = df.withColumn("landing", F.lit(content_id(df)))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upload_date", "landing").parquet(root)
