"""Fixture views over the driver's TESTDATA tables (see FIXTURES.md).

Each view maps a generic table onto a shape the reference reads or writes
(prediction log, evaluation rows, pictures, catalogue, history). Views are
plain projections/aggregates of the source tables, so their work grows with
the tables. The DuckDB twins live in ``imagelake.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import table

# fixed values: the stand-in training history of the reference notebook
# (10 epochs; accuracy, val_accuracy, loss, val_loss).
REFERENCE_HISTORY = {
    "accuracy": [0.85, 0.90, 0.93, 0.95, 0.96, 0.97, 0.97, 0.98, 0.98, 0.98],
    "val_accuracy": [0.84, 0.89, 0.92, 0.94, 0.95, 0.96, 0.96, 0.97, 0.97, 0.97],
    "loss": [0.45, 0.35, 0.28, 0.22, 0.18, 0.15, 0.14, 0.12, 0.11, 0.10],
    "val_loss": [0.48, 0.38, 0.30, 0.25, 0.21, 0.18, 0.17, 0.15, 0.14, 0.13],
}

PRED_LOG_SQL = """
SELECT event_id,
  concat('u', CAST(user_id AS STRING), '-', date_format(ts, 'yyyyMMdd')) AS session_id,
  concat(event_type, '_', CAST(event_id AS STRING), '.',
         CASE event_id % 20 WHEN 0 THEN 'gif' WHEN 1 THEN 'PNG' ELSE 'jpg' END) AS filename,
  CAST(event_id % 15 AS INT) AS y_true,
  CAST(CASE WHEN (event_id * 31) % 100 < 8
       THEN (event_id % 15 + 1 + event_id % 14) % 15 ELSE event_id % 15 END AS INT) AS y_pred,
  CAST(1048576 - ((event_id * 7919) % 1024) * ((event_id * 104729) % 1024) AS DOUBLE)
    / CAST(1048576 AS DOUBLE) AS confidence,
  event_type = 'error' AS is_error,
  CAST(get_json_object(props, '$.k') AS INT) AS k,
  CAST(ts AS TIMESTAMP) AS received_at,
  user_id, event_type
FROM {events}
"""


def pred_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log, requests, frames and evaluation rows in one view."""
    events = table(spark, sf_dir, "events")
    base = events.select(
        "event_id", "user_id", "event_type", "ts", "props")
    v = spark.sql(PRED_LOG_SQL.format(events="{ev}"), ev=base)
    return v.withColumn("processed_at", F.expr("timestampadd(SECOND, k % 90, received_at)"))


def with_outcome(log: DataFrame, names: DataFrame) -> DataFrame:
    """Add the reference's encoded scoring text: ``name|confidence`` or ``error|bad image``."""
    j = log.join(F.broadcast(names.withColumnRenamed("name", "_name")),
                 log["y_pred"] == F.col("class_id"), "left").drop("class_id")
    return j.withColumn(
        "outcome",
        F.when(F.col("is_error"), F.lit("error|bad image"))
         .otherwise(F.concat_ws("|", F.col("_name"), F.col("confidence").cast("string")))
    ).drop("_name")


def eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``eval(run_id, item_id, y_true, y_pred, confidence)``; one run per event type."""
    return pred_log(spark, sf_dir).select(
        F.col("event_type").alias("run_id"), F.col("event_id").alias("item_id"),
        "y_true", "y_pred", "confidence")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``history(run_id, epoch, metric, value)``: the reference's stand-in run plus
    one run per event type with the 30 days of January as epochs."""
    lit_rows = [("reference", e, m, float(v))
                for m, vals in REFERENCE_HISTORY.items() for e, v in enumerate(vals)]
    from .dims import local_table
    lit = local_table(spark, lit_rows, ["run_id", "epoch", "metric", "value"])
    log = pred_log(spark, sf_dir)
    train = (F.col("k") % 2) == 0
    hit = (F.col("y_true") == F.col("y_pred")).cast("double")
    daily = (log.groupBy(F.col("event_type").alias("run_id"),
                         (F.dayofmonth("received_at") - 1).cast("int").alias("epoch"))
             .agg(F.avg(F.when(train, hit)).alias("accuracy"),
                  F.avg(F.when(~train, hit)).alias("val_accuracy"),
                  F.avg(F.when(train, 1 - F.col("confidence"))).alias("loss"),
                  F.avg(F.when(~train, 1 - F.col("confidence"))).alias("val_loss")))
    long = daily.select("run_id", "epoch", F.expr(
        "stack(4, 'accuracy', accuracy, 'val_accuracy', val_accuracy, "
        "'loss', loss, 'val_loss', val_loss) AS (metric, value)")).where(F.col("value").isNotNull())
    # a metric without rows that day is not measured: no history row
    return lit.unionByName(long)


def pix8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8x8x1 pictures: ``floor((x+1)*127.5)`` of each embedding value, as DOUBLE."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        "vec_id", "label",
        F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("n_channels"),
        F.transform("embedding",
                    lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("double")).alias("pixels"))


def pix3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8x8x3 pictures of all values of pix8: the second and third channel start 21 and 42
    values further on."""
    p = pix8(spark, sf_dir)
    three = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.array(
        *[F.element_at("pixels", (i + shift) % 64 + 1) for shift in (0, 21, 42)])))
    return p.select("vec_id", "label", "height", "width", F.lit(3).alias("n_channels"), three.alias("pixels"))


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 slices of 8 raw values per embedding: ``(vec_id, slice_id, vals)``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.posexplode(F.sequence(F.lit(0), F.lit(7))).alias("slice_id", "_s"),
                      "embedding").select(
        "vec_id", F.col("slice_id").cast("int").alias("slice_id"),
        F.expr("slice(embedding, slice_id * 8 + 1, 8)").alias("vals"))


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten raw class scores per embedding: score k sums the values k, k + 10, k + 20, ..."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("item_id"),
        F.transform(F.sequence(F.lit(0), F.lit(9)),
                    lambda k: F.aggregate(F.filter("embedding", lambda x, i: i % 10 == k), F.lit(0.0).cast("double"),
                                          lambda acc, x: acc + x.cast("double"))).alias("scores"),
        F.col("label").alias("y_true"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, path)`` from ``pages.url`` without query or fragment, plus split."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        F.regexp_replace("url", r"[?#].*$", "").alias("path"),
        F.when(F.col("page_id") % 10 == 0, "test")
         .when(F.col("page_id") % 10 == 1, "validation").otherwise("train").alias("split"))


# fixed values: the class set of the pages-based catalogue fixture.
PAGE_CLASSES = ["de", "en", "es", "fr"]


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``frames(stream_id, frame_no, ts, y_pred, confidence, is_error)``: one camera per
    user, frames numbered from 0 by event_id (fixture numbering only)."""
    from .functions.ranks import group_row_number
    log = pred_log(spark, sf_dir)
    # The camera supplies frame_no in production; here it is derived from event
    # order per user with distributed row numbers (no per-user window task).
    numbered = group_row_number(log.select("user_id", "event_id", "received_at", "y_pred", "confidence",
                                           "is_error"), ["user_id"], ["event_id"], out_col="frame_no")
    return numbered.select(
        F.concat(F.lit("cam"), F.col("user_id").cast("string")).alias("stream_id"),
        F.col("frame_no").cast("long").alias("frame_no"),
        F.col("received_at").alias("ts"), "y_pred", "confidence", "is_error")


def images_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects found in the landing area: one per ``labels`` row, with a picture
    shape (toxic -> undecodable, height -1; quality 0 -> 8x7)."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(
        F.col("doc_id").alias("object_id"),
        F.when(F.col("toxic") == 1, -1).otherwise(8).cast("int").alias("height"),
        F.when(F.col("quality") == 0, 7).otherwise(8).cast("int").alias("width"),
        F.lit(1).cast("int").alias("n_channels"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload requests: one per ``documents`` row."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("object_id"),
        F.concat(F.lit("s"), (F.col("doc_id") % 97).cast("string")).alias("session_id"),
        F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("filename"),
        F.col("n_chars").alias("size_bytes"))
