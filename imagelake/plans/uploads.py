"""Publish an upload: land pictures (B1) and send one request
message per picture (B2), rejecting files of the wrong type or size (C2) and
whole oversized sessions (C3) first.

Pictures under ``root/<session_id>/<file>`` are decoded in the JVM by the
``image`` source (A2) and sized by a ``binaryFile`` listing that reads no bytes;
the landing table holds the decoded pictures, partitioned by upload date, so the
scoring stream (E6) reads only the dates a batch mentions. Nothing passes
through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import basename, norm_path
from ..operators.validate import session_cap, upload_filter
from ..sinks.messages import message_sink, message_value
from ..sinks.uploads import land_uploads, write_uploads
from ..sources.images import image_scan


def upload_requests(spark: SparkSession, root: str) -> DataFrame:
    """One row per picture under ``root/<session_id>/<file>``: session, file name,
    size, upload time and decoded pixels (height -1 when undecodable)."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select(norm_path("path").alias("path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("uploaded_at")))
    pics = image_scan(spark, root).select("path", "height", "width", "n_channels", "pixels")
    parts = F.split("path", r"[/\\]")
    return (listing.join(pics, "path", "left")
                   .withColumn("session_id", F.try_element_at(parts, F.lit(-2)))
                   .withColumn("filename", basename("path")))


def publish_uploads(requests: DataFrame, base_url: str, landing_root: str, message_options: dict,
                    message_format: str = "kafka", max_files: int = 10) -> DataFrame:
    """Validate, land and announce uploads; returns the accepted requests."""
    ok = session_cap(upload_filter(requests), n=max_files)
    landed = land_uploads(ok, base_url).persist()
    try:
        write_uploads(landed.drop("path"), landing_root)
        message_sink(message_value(landed), message_options, fmt=message_format)
    finally:
        landed.unpersist()
    return landed.drop("pixels")
