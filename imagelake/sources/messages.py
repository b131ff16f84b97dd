"""Upload-request messages: subscribe, parse, type (A3-A5).

The request topic is read with Structured Streaming. Where the Kafka connector
is not on the classpath, a folder of JSON-lines files is the drop-in (same
``value`` column). Every endpoint and credential comes from ``options``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the request message, four nullable strings.
REQUEST_SCHEMA = T.StructType([
    T.StructField("image_url", T.StringType(), True),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("filename", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
])


def message_stream(spark: SparkSession, options: dict, fmt: str = "kafka",
                   max_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with a string ``value`` column (A3).

    ``fmt="kafka"``: ``options`` holds ``kafka.bootstrap.servers`` and ``subscribe``;
    by default reading starts at the latest offsets and tolerates data loss, as
    the reference does. ``fmt="text"``: ``options["path"]`` is a folder of
    JSON-lines files."""
    if fmt == "kafka":
        opts = {"startingOffsets": "latest", "failOnDataLoss": "false", **options}
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        df = spark.readStream.format("kafka").options(**opts).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("partition"), F.col("offset"))
    r = spark.readStream.format("text")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.load(options["path"])


def parse_messages(df: DataFrame, schema: T.StructType = REQUEST_SCHEMA, value_col: str = "value") -> DataFrame:
    """JSON value -> typed columns (A4); keeps the raw text and flags messages that
    do not parse or carry none of the fields."""
    parsed = df.withColumn("_m", F.from_json(F.col(value_col).cast("string"), schema))
    fields = [F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields]
    present = [F.col(f"_m.{f.name}").isNotNull() for f in schema.fields]
    any_present = present[0]
    for p in present[1:]:
        any_present = any_present | p
    return parsed.select(*[c for c in df.columns if c != value_col], F.col(value_col).alias("raw"), *fields,
                         (F.col("_m").isNull() | ~any_present).alias("is_malformed"))


def type_messages(df: DataFrame, ts_col: str = "timestamp", out_col: str = "received_at") -> DataFrame:
    """ISO-8601 text -> event time (A5); text that does not parse gives null."""
    return df.withColumn(out_col, F.try_to_timestamp(F.col(ts_col)))
