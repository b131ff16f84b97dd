"""Streaming scoring job (E6) and its runner.

requests (A3) -> parse (A4) -> type (A5) -> foreachBatch:
    fetch landed pictures (A6) -> preprocess (D1/D2) -> score (E1) -> argmax (E3)
    -> label (E4) -> prediction log + error log (B3, B5).

The stream itself is stateless. Pictures are looked up inside each micro-batch by
``(upload_date, object_key)``. ``upload_date`` is the partition column of the landing
table; the batch's dates become a literal filter on it, so only those dates are
listed and read, and uploads that landed after the stream started are seen. A Bloom filter
of the batch's keys drops other pictures in the scan (``sources.fetch``).
A request whose picture is not there yet becomes ``error='not found'``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.tensors import has_shape, scale_signed, scale_unit
from ..operators.enrich import decode_label
from ..operators.scoring import ModelSpec, score_batch
from ..sinks.predictions import predictions_sink
from ..sources.fetch import fetch_pixels, image_fetch, landed_for, newest_landed
from ..sources.messages import message_stream, parse_messages, type_messages

SCALERS = {"unit": scale_unit, "signed": scale_signed}


def run_stream(df: DataFrame, sink, checkpoint: str, available_now: bool = True,
               processing_time: str | None = None, name: str | None = None) -> StreamingQuery:
    """Start ``df`` into a ``foreachBatch`` sink in append mode with a checkpoint.
    ``available_now`` drains what is there and stops (tests, catch-up jobs)."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        w = w.queryName(name)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


@dataclass
class ScoringJob:
    """Configuration of the scoring stream; endpoints and paths come from the caller. With ``jdbc``
    (options of Spark's source: url, driver, credentials) the logs are database tables."""
    source_options: dict
    landing_root: str
    target: str | None
    errors_target: str | None
    checkpoint: str
    spec: ModelSpec
    shape: tuple[int, int, int]
    source_format: str = "kafka"
    max_per_trigger: int | None = None
    jdbc: dict | None = None
    table: str = "predictions"
    errors_table: str = "prediction_errors"


def object_key(url_col: str = "image_url") -> F.Column:
    """Object key of a landed picture: the ``uploads/<date>/...`` suffix of its URL, or null."""
    return F.nullif(F.regexp_extract(F.col(url_col), r"(uploads/\d{8}/.*)$", 1), F.lit(""))


KEY = ["upload_date", "object_key"]


def score_requests(requests: DataFrame, landed: DataFrame, spec: ModelSpec, classes: DataFrame,
                   shape: tuple[int, int, int]) -> DataFrame:
    """Batch core of E6: one row per request, scored (``error`` null) or with its error.

    A malformed message is an error row like any other; a URL that names no upload, like a key
    that never landed, is ``not found``. Of a key that landed twice the newest picture counts.
    Shapes are judged before pixels are read, and each picture is scored once, however many
    requests name it: requests meet scores, not pixels."""
    h, w, c = shape
    keep = ["session_id", "filename", "image_url", "received_at"]
    malformed = requests.where(F.coalesce("is_malformed", F.lit(True))).select(*keep, F.lit("malformed message").alias("error"))
    reqs = (requests.where(~F.col("is_malformed")).withColumn("object_key", object_key())
                    .withColumn("upload_date", F.substring("object_key", 9, 8)).select(*keep, *KEY))
    named = reqs.where(F.col("object_key").isNotNull())
    keys = named.select(*KEY).distinct()
    # read back from its folder name a date is a number; keys meet, and are hashed, as text
    landed = landed_for(keys, landed).withColumn("upload_date", F.col("upload_date").cast("string"))
    found = newest_landed(landed, keys, KEY, ["height", "width", "n_channels"])
    fits = F.coalesce((F.col("height") == h) & (F.col("width") == w) & (F.col("n_channels") == c), F.lit(False))
    pictures = fetch_pixels(landed, found.where(fits), KEY).where(has_shape("pixels", h, w, c))
    feats = pictures.withColumn("features", SCALERS.get(spec.scaling, lambda x: F.col(x))("pixels"))
    scored = score_batch(feats, spec, "features", keep=KEY, input_scaling=spec.scaling)
    labelled = decode_label(scored.drop("probs"), classes, id_col="class_id", out_col="fruit").drop("class_id")
    state = F.when(F.col("height") < 0, "processing error").when(~fits, "bad shape")
    fetched = image_fetch(named, found.select(*KEY, state.alias("_state")), key=KEY).join(
        labelled.withColumn("_scored", F.lit(True)), KEY, "left")
    error = F.coalesce("fetch_error", "_state", F.when(F.col("_scored").isNull(), F.lit("bad shape")))
    done = fetched.select(*keep, "fruit", "confidence", error.alias("error"))
    lost = reqs.where(F.col("object_key").isNull()).select(*keep, F.lit("not found").alias("error"))
    return done.unionByName(lost.unionByName(malformed), allowMissingColumns=True).withColumn("processed_at", F.current_timestamp())


def start_scoring(spark: SparkSession, job: ScoringJob, classes: DataFrame,
                  available_now: bool = True) -> StreamingQuery:
    """Start the scoring stream."""
    raw = message_stream(spark, job.source_options, job.source_format, job.max_per_trigger)
    typed = type_messages(parse_messages(raw))

    def score(batch_df: DataFrame, batch_id: int) -> DataFrame:
        landed = spark.read.parquet(job.landing_root)  # listed per batch: new uploads are seen
        return score_requests(batch_df, landed, job.spec, classes, job.shape)

    sink = predictions_sink(job.target, job.errors_target, job.jdbc, job.table, job.errors_table, score=score)
    return run_stream(typed, sink, job.checkpoint, available_now=available_now)
