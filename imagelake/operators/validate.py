"""Validation and filtering of uploads, requests and scored outcomes.

Every check is a column expression or a join against a bounded dimension;
per-session counts come from a partial aggregate, never a window over raw rows,
so a hot session cannot pin one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import file_ext

# fixed values: accepted upload types and size limit (200 MB per file), and the
# per-session file cap.
UPLOAD_EXTENSIONS = ["jpg", "png", "jpeg"]
MAX_UPLOAD_BYTES = 200 * 1024 * 1024
SESSION_FILE_CAP = 10


def class_filter(df: DataFrame, classes: DataFrame, label_col: str = "label",
                 name_col: str = "name") -> DataFrame:
    """Keep rows whose label is a known class (C1): broadcast left-semi join on a
    dimension bounded by the class count."""
    dim = F.broadcast(classes.select(F.col(name_col).alias("_cls")).distinct())
    return df.join(dim, df[label_col] == dim["_cls"], "left_semi")


def upload_filter(df: DataFrame, name_col: str = "filename", size_col: str = "size_bytes",
                  exts: list[str] | None = None, max_bytes: int = MAX_UPLOAD_BYTES) -> DataFrame:
    """Keep accepted picture types up to the size limit."""
    exts = UPLOAD_EXTENSIONS if exts is None else exts
    return df.where(file_ext(name_col).isin(exts) & (F.col(size_col) <= max_bytes))


def session_counts(df: DataFrame, session_col: str = "session_id") -> DataFrame:
    """Files per session as a partial (map-side combined) aggregate."""
    return df.groupBy(session_col).agg(F.count(F.lit(1)).alias("n_files"))


def session_cap(df: DataFrame, n: int = SESSION_FILE_CAP,
                session_col: str = "session_id") -> DataFrame:
    """Drop every session with more than ``n`` files (C3). Whole sessions are
    rejected, never truncated. The per-session count is a partial aggregate; it
    is joined back with ``salted_join``, so a session holding a large share of
    all rows is spread over many tasks instead of one."""
    from ..functions.skew import salted_join
    counts = session_counts(df, session_col)
    ok = counts.where(F.col("n_files") <= n)
    return salted_join(df, ok, [session_col], "left_semi", size_col="n_files", sizes=counts)


def rejected_sessions(df: DataFrame, n: int = SESSION_FILE_CAP,
                      session_col: str = "session_id") -> DataFrame:
    """Sessions refused by the cap, with their file counts."""
    return session_counts(df, session_col).where(F.col("n_files") > n)


# fixed values: the reasons an input can fail, in the reference's order.
REASONS = ["ok", "not found", "bad shape", "processing error"]


def classify_inputs(requests: DataFrame, images: DataFrame, key: str = "object_id",
                    shape: tuple[int, int, int] = (8, 8, 1)) -> DataFrame:
    """Reason per request (C4): ``not found`` without an image, ``processing error``
    when the picture could not be decoded (height -1), ``bad shape`` when the
    decoded size differs from ``shape``, else ``ok``."""
    h, w, c = shape
    img = images.select(key, F.col("height").alias("_h"), F.col("width").alias("_w"),
                        F.col("n_channels").alias("_c"))
    # both sides are shuffled here, so a picture named by many requests is split by
    # adaptive execution's skew join
    j = requests.join(img, key, "left")
    reason = (F.when(F.col("_h").isNull(), "not found")
              .when(F.col("_h") < 0, "processing error")
              .when((F.col("_h") != h) | (F.col("_w") != w) | (F.col("_c") != c), "bad shape")
              .otherwise("ok"))
    return j.withColumn("reason", reason).drop("_h", "_w", "_c")


def reason_counts(classified: DataFrame) -> DataFrame:
    """Count per reason (C4), zero rows kept for every reason."""
    from ..dims import local_table
    reasons = F.broadcast(local_table(classified.sparkSession, [(r,) for r in REASONS], ["reason"]))
    counts = classified.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return reasons.join(counts, "reason", "left").select(
        "reason", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def split_valid_rejected(df: DataFrame, ok_col: str = "reason",
                         ok_value: str = "ok") -> tuple[DataFrame, DataFrame]:
    """Two outputs over one input (C5). The caller persists the input when both are
    consumed; nothing is collected."""
    ok = F.col(ok_col) == ok_value
    return df.where(ok), df.where(~ok | F.col(ok_col).isNull())


def confidence_guard(df: DataFrame, col: str = "confidence") -> DataFrame:
    """Keep 0 <= confidence <= 1 (C6); null and NaN are rejected (a null
    comparison is unknown and Spark orders NaN above every number, so the range
    test alone rejects both without evaluating the column again)."""
    return df.where(F.col(col).between(0.0, 1.0))


def confidence_rejects(df: DataFrame, col: str = "confidence") -> DataFrame:
    """The rows that ``confidence_guard`` leaves out (C6), with the ``reason``: with it they are all rows."""
    c = F.col(col)
    reason = (F.when(c.isNull(), "no confidence").when(F.isnan(c), "not a number")
              .when(c < 0, "below 0").when(c > 1, "above 1"))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def decode_outcome(df: DataFrame, col: str = "outcome") -> DataFrame:
    """Split ``fruit|confidence`` / ``error|message`` text into typed columns (C7):
    ``fruit``, ``confidence`` (``try_cast``), ``error``. A confidence that does not
    parse becomes an error instead of failing the batch."""
    parts = F.split(F.col(col), r"\|", 2)  # the text is split once
    head = F.element_at(parts, 1)
    tail = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    is_err = head == "error"
    conf = tail.try_cast("double")
    return (df.withColumn("fruit", F.when(~is_err, head))
              .withColumn("confidence", F.when(~is_err, conf))
              .withColumn("error", F.when(is_err, tail)
                          .when(conf.isNull(), F.lit("bad confidence"))))


def integrity(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Size and SHA-256 of each item."""
    c = F.col(content_col)
    return df.withColumn("size_bytes", F.octet_length(c).cast("long")).withColumn(
        "sha256", F.sha2(c, 256))
