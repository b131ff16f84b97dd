"""Session and result queries over the prediction log.

Per-session metrics are partial aggregates (map-side combine), "first per group"
uses ``min_by`` aggregates, and top-k per group uses ``row_number() <= k`` which
Spark plans with a partial WindowGroupLimit before the shuffle. No window runs
over an unbounded group of raw rows, so a session holding a third of all rows
still spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import salted_join

RESULT_TIMEOUT_S = 60  # fixed value: the result wait limit of the upload app


def session_results(log: DataFrame, session_id: str) -> DataFrame:
    """One session's rows ordered by processing time (G1); the filter reaches the scan."""
    return (log.where(F.col("session_id") == session_id)
               .select("filename", "fruit", "confidence", "processed_at", "image_url")
               .orderBy("processed_at", "filename"))


def latest(log: DataFrame, n: int = 10, order_col: str = "processed_at",
           tie_col: str = "id") -> DataFrame:
    """Newest ``n`` predictions (G2), ties broken by key: TakeOrderedAndProject."""
    return log.orderBy(F.col(order_col).desc(), F.col(tie_col).desc()).limit(n)


def session_stats(log: DataFrame) -> DataFrame:
    """Count and mean confidence per session, newest first."""
    return (log.groupBy("session_id")
               .agg(F.count(F.lit(1)).alias("total"),
                    F.avg("confidence").alias("avg_conf"),
                    F.max("processed_at").alias("last_processed_at"))
               .orderBy(F.col("last_processed_at").desc(), "session_id"))


def n_classes(col: str, names: list[str]) -> Column:
    """Number of distinct names as an aggregate: one bit per name of the list (at most 63), merged by
    ``bit_or``, so rows are combined before the shuffle. Names outside the list are one more."""
    places = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    place = F.when(F.col(col).isNotNull(), F.coalesce(F.try_element_at(places, F.col(col)), F.lit(len(names))))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    return F.bit_count(F.coalesce(F.bit_or(bit), F.lit(0).cast("long"))).cast("long")


def session_summary(log: DataFrame, class_names: list[str] | None = None) -> DataFrame:
    """Total, mean confidence, distinct fruits and elapsed seconds per session (G4). With the
    class list, fruits are counted as bits in the one aggregate; without it by ``count_distinct``."""
    return log.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_images"),
        F.avg("confidence").alias("avg_confidence"),
        (n_classes("fruit", class_names) if class_names else F.count_distinct("fruit")).alias("n_fruits"),
        ((F.unix_micros(F.max("processed_at")) - F.unix_micros(F.min("received_at")))
         / F.lit(1e6)).alias("elapsed_s"))


def class_distribution(log: DataFrame, by: list[str] | None = None,
                       only_mixed: bool = True) -> DataFrame:
    """Count per fruit within each ``by`` group (G5); with ``only_mixed`` only groups
    holding more than one fruit are kept, as the chart is shown only then."""
    by = ["session_id"] if by is None else by
    counts = log.groupBy(*by, "fruit").agg(F.count(F.lit(1)).alias("n"))
    if not only_mixed:
        return counts
    if not by:
        # Overall distribution: the window runs over the aggregate (one row per
        # fruit, bounded by the class count), not over raw rows.
        k = F.count(F.col("fruit")).over(Window.partitionBy())
        return counts.withColumn("_k", k).where(F.col("_k") > 1).drop("_k")
    # a group holds more than one fruit if its first and last name differ; windows over counts
    group = Window.partitionBy(*by)
    ends = counts.withColumn("_first", F.min("fruit").over(group)).withColumn("_last", F.max("fruit").over(group))
    return ends.where(F.col("_first") < F.col("_last")).drop("_first", "_last")


def match_uploads(results: DataFrame, uploads: DataFrame,
                  keys: tuple[str, ...] = ("session_id", "filename"),
                  order_cols: tuple[str, ...] = ("uploaded_at", "upload_id")) -> DataFrame:
    """Join each result to the first upload with the same name (G6). The first
    upload per key is a ``min_by`` aggregate (partial, bounded per group).
    Upload payload columns must not clash with result columns."""
    keys = list(keys)
    payload = [c for c in uploads.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    first = uploads.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in payload]), order).alias("_u"),
        F.count(F.lit(1)).alias("_rows")).select(*keys, "_u.*", "_rows")
    # every result comes from an upload, so the upload count per key (computed in
    # the same aggregate) sizes the result groups for hot-key detection
    return salted_join(results, first, keys, "left", size_col="_rows").drop("_rows")


def request_completeness(requests: DataFrame, results: DataFrame, key: str = "request_id",
                         timeout_s: int = RESULT_TIMEOUT_S) -> DataFrame:
    """Status per request (G7): ``done`` / ``error`` when a result arrived within
    ``timeout_s`` after the request, else ``timed out`` (the same interval as the
    streaming form). Results outside that interval do not count; the others are
    reduced to the first one per request before the join."""
    asked = requests.select(key, F.col("received_at").alias("_asked"))
    deadline = F.col("_asked") + F.make_dt_interval(secs=F.lit(timeout_s))
    in_time = results.select(key, "processed_at", "error").join(asked, key).where(
        F.col("processed_at").between(F.col("_asked"), deadline))
    # of results at one instant, a success comes before an error
    first = in_time.groupBy(key).agg(F.min_by(
        F.struct("processed_at", "error"), F.struct("processed_at", F.coalesce("error", F.lit("")))).alias("_r"))
    j = requests.join(first, key, "left")
    status = (F.when(F.col("_r").isNull(), "timed out")
              .when(F.col("_r.error").isNotNull(), "error").otherwise("done"))
    return j.select(*requests.columns, F.col("_r.processed_at").alias("processed_at"),
                    F.col("_r.error").alias("error"), status.alias("status"))


def session_completeness(per_request: DataFrame) -> DataFrame:
    """Per session: requests, done, errors, timed out, complete flag."""
    s = F.col("status")
    return per_request.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count(F.when(s == "done", 1)).alias("n_done"),
        F.count(F.when(s == "error", 1)).alias("n_error"),
        F.count(F.when(s == "timed out", 1)).alias("n_timed_out"),
    ).withColumn("complete", F.col("n_timed_out") == 0)


def session_preview(df: DataFrame, k: int = 5, order_cols: tuple[str, ...] = ("uploaded_at", "filename")
                    ) -> DataFrame:
    """First ``k`` files per session and how many more there are.
    ``row_number() <= k`` is planned with a partial per-group limit before the
    shuffle; the session size comes from a partial aggregate."""
    w = Window.partitionBy("session_id").orderBy(*order_cols)
    firsts = (df.select("session_id", "filename", *[c for c in order_cols if c != "filename"])
                .withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k))
    sizes = df.groupBy("session_id").agg(F.count(F.lit(1)).alias("_n"))
    return (firsts.join(sizes, "session_id")
                  .select("session_id", "pos", "filename",
                          F.greatest(F.col("_n") - k, F.lit(0)).alias("n_more")))
