"""Registered queries: flagship, validation (C), enrichment (E4, F), sessions (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..dims import CLASS_NAMES, class_dim, price_dim
from ..functions.names import basename, capitalize, title
from ..operators import enrich, sessions, validate
from ..oracle import cte
from ..registry import register
from ..session import table
from .session_report import priced_results, session_report

# ---------------------------------------------------------------------------
# shared DuckDB text: decode (C7) -> guard (C6) -> price (F1)
TYPED = """typed AS (
  SELECT * EXCLUDE (confidence),
    CASE WHEN split_part(outcome, '|', 1) <> 'error' THEN split_part(outcome, '|', 1) END AS fruit,
    CASE WHEN split_part(outcome, '|', 1) <> 'error'
         THEN try_cast(split_part(outcome, '|', 2) AS DOUBLE) END AS confidence,
    CASE WHEN split_part(outcome, '|', 1) = 'error' THEN split_part(outcome, '|', 2)
         WHEN try_cast(split_part(outcome, '|', 2) AS DOUBLE) IS NULL THEN 'bad confidence' END AS error
  FROM outcomes)"""
VALID = """valid AS (
  SELECT * FROM typed WHERE error IS NULL AND confidence IS NOT NULL
    AND NOT isnan(confidence) AND confidence BETWEEN 0 AND 1)"""
PRICED = """priced AS (
  SELECT v.*, coalesce(p.price_text, 'Precio no disponible') AS price_text, p.price
  FROM valid v LEFT JOIN (SELECT * FROM price_dim WHERE catalog = 'app') p
    ON lower(v.fruit) = lower(p.name))"""


def _priced_cte() -> str:
    return cte("outcomes", "price_dim") + ", " + TYPED + ",\n" + VALID + ",\n" + PRICED + "\n"


G4_SQL = _priced_cte() + """
SELECT session_id, count(*) AS n_images, avg(confidence) AS avg_confidence,
  count(DISTINCT fruit) AS n_fruits,
  (epoch_us(max(processed_at)) - epoch_us(min(received_at))) / 1e6 AS elapsed_s
FROM priced GROUP BY session_id"""


@register("flagship_session_report", G4_SQL)
def q_flagship(spark, sf):
    """events -> C7 -> C6 -> F1 -> G4 (the entry query, any scale)."""
    return session_report(spark, sf)


# --- C: validation -----------------------------------------------------------

@register("C1_class_filter", cte("catalogue", "page_class_dim") + """
SELECT c.page_id, c.path, c.split, string_split_regex(c.path, '[/\\\\]')[-2] AS label
FROM catalogue c
WHERE string_split_regex(c.path, '[/\\\\]')[-2] IN (SELECT name FROM page_class_dim)""")
def q_c1(spark, sf):
    from ..operators.datasets import catalog_from_paths
    cat = catalog_from_paths(fx.catalogue(spark, sf))
    return validate.class_filter(cat, class_dim(spark, fx.PAGE_CLASSES)).select(
        "page_id", "path", "split", "label")


@register("C2_upload_filter", cte("pred_log") + """
SELECT event_id, filename, CAST(k * 3 * 1024 * 1024 AS BIGINT) AS size_bytes
FROM pred_log
WHERE lower(regexp_extract(filename, '\\.([^./\\\\]+)$', 1)) IN ('jpg', 'png', 'jpeg')
  AND CAST(k * 3 * 1024 * 1024 AS BIGINT) <= 209715200""")
def q_c2(spark, sf):
    log = fx.pred_log(spark, sf).select(
        "event_id", "filename", (F.col("k") * 3 * 1024 * 1024).cast("long").alias("size_bytes"))
    return validate.upload_filter(log)


@register("C3_session_cap", cte("pred_log") + """
SELECT event_id, session_id FROM pred_log
WHERE session_id IN (SELECT session_id FROM pred_log GROUP BY session_id HAVING count(*) <= 5)""")
def q_c3(spark, sf):
    return validate.session_cap(fx.pred_log(spark, sf).select("event_id", "session_id"), n=5)


C4_SQL = cte("requests", "images_found") + """
, classified AS (
  SELECT r.object_id, r.session_id, r.filename,
    CASE WHEN i.height IS NULL THEN 'not found'
         WHEN i.height < 0 THEN 'processing error'
         WHEN i.height <> 8 OR i.width <> 8 OR i.n_channels <> 1 THEN 'bad shape'
         ELSE 'ok' END AS reason
  FROM requests r LEFT JOIN images_found i ON r.object_id = i.object_id)"""


@register("C4_classify_inputs", C4_SQL + """
SELECT object_id, session_id, filename, reason FROM classified""")
def q_c4(spark, sf):
    c = validate.classify_inputs(fx.requests(spark, sf), fx.images_found(spark, sf))
    return c.select("object_id", "session_id", "filename", "reason")


@register("C4_reason_counts", C4_SQL + """
SELECT r.reason, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (VALUES ('ok'), ('not found'), ('bad shape'), ('processing error')) r(reason)
LEFT JOIN (SELECT reason, count(*) AS n FROM classified GROUP BY reason) c ON r.reason = c.reason""")
def q_c4_counts(spark, sf):
    c = validate.classify_inputs(fx.requests(spark, sf), fx.images_found(spark, sf))
    return validate.reason_counts(c)


@register("C5_split_rejected", C4_SQL + """
SELECT object_id, reason FROM classified WHERE reason <> 'ok'""")
def q_c5(spark, sf):
    c = validate.classify_inputs(fx.requests(spark, sf), fx.images_found(spark, sf))
    _, rejected = validate.split_valid_rejected(c)
    return rejected.select("object_id", "reason")


@register("C5_split_valid", C4_SQL + """
SELECT object_id, filename FROM classified WHERE reason = 'ok'""")
def q_c5v(spark, sf):
    c = validate.classify_inputs(fx.requests(spark, sf), fx.images_found(spark, sf))
    valid, _ = validate.split_valid_rejected(c)
    return valid.select("object_id", "filename")


@register("C6_confidence_guard", cte("pred_log") + """
SELECT event_id, (confidence - 0.5) * 2.5 AS confidence FROM pred_log
WHERE (confidence - 0.5) * 2.5 BETWEEN 0 AND 1""")
def q_c6(spark, sf):
    # stretched confidences fall on both sides of [0, 1]
    log = fx.pred_log(spark, sf).select("event_id", ((F.col("confidence") - 0.5) * 2.5).alias("confidence"))
    return validate.confidence_guard(log)


@register("C6_confidence_rejects", cte("pred_log") + """
SELECT event_id, c AS confidence, CASE WHEN c < 0 THEN 'below 0' ELSE 'above 1' END AS reason
FROM (SELECT event_id, (confidence - 0.5) * 2.5 AS c FROM pred_log) AS x WHERE c < 0 OR c > 1""")
def q_c6r(spark, sf):
    log = fx.pred_log(spark, sf).select("event_id", ((F.col("confidence") - 0.5) * 2.5).alias("confidence"))
    return validate.confidence_rejects(log)


@register("C7_decode_outcome", cte("outcomes") + ", " + TYPED + """
SELECT event_id, fruit, confidence, error FROM typed""")
def q_c7(spark, sf):
    log = fx.with_outcome(fx.pred_log(spark, sf), class_dim(spark))
    return validate.decode_outcome(log.drop("confidence")).select("event_id", "fruit", "confidence", "error")


@register("C8_basename", cte("catalogue") + """
SELECT page_id, split_part(path, '/', -1) AS file_name FROM catalogue""")
def q_c8(spark, sf):
    return fx.catalogue(spark, sf).select("page_id", basename("path").alias("file_name"))


@register("C9_integrity_manifest", """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size_bytes, sha256(text) AS sha256 FROM documents""")
def q_c9(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return validate.integrity(docs, "text").select("doc_id", "size_bytes", "sha256")


# --- E4, F: labels, prices, records -----------------------------------------

@register("E4_decode_label", cte("pred_log", "class_dim") + """
SELECT p.event_id, p.y_pred, c.name AS fruit FROM pred_log p LEFT JOIN class_dim c ON p.y_pred = c.class_id""")
def q_e4(spark, sf):
    log = fx.pred_log(spark, sf).select("event_id", "y_pred")
    return enrich.decode_label(log, class_dim(spark), id_col="y_pred")


@register("F1_price_lookup", _priced_cte() + """
SELECT event_id, fruit, price_text, CAST(price AS DOUBLE) AS price FROM priced""")
def q_f1(spark, sf):
    return priced_results(spark, sf).select(
        "event_id", "fruit", "price_text", F.col("price").cast("double").alias("price"))


@register("F1_price_lookup_webcam", cte("pred_log", "class_dim", "price_dim") + """
SELECT p.event_id, c.name AS fruit, coalesce(d.price_text, 'N/A') AS price_text,
  CAST(d.price AS DOUBLE) AS price
FROM pred_log p LEFT JOIN class_dim c ON p.y_pred = c.class_id
LEFT JOIN (SELECT * FROM price_dim WHERE catalog = 'webcam') d ON lower(c.name) = lower(d.name)""")
def q_f1w(spark, sf):
    named = enrich.decode_label(fx.pred_log(spark, sf).select("event_id", "y_pred"),
                                class_dim(spark), id_col="y_pred")
    return enrich.price_lookup(named, price_dim(spark), catalog="webcam").select(
        "event_id", "fruit", "price_text", F.col("price").cast("double").alias("price"))


@register("F2_display_name", cte("class_dim", "pred_log") + """
SELECT class_id, concat(upper(left(name, 1)), lower(substr(name, 2))) AS capitalized,
  list_aggregate(list_transform(string_split(name, ' '),
      lambda w: concat(upper(left(w, 1)), lower(substr(w, 2)))), 'string_agg', ' ') AS titled
FROM class_dim WHERE class_id IN (SELECT y_pred FROM pred_log)""")
def q_f2(spark, sf):
    # class names are the only display names; read through the log so the work
    # scales with it: one row per class actually predicted.
    used = fx.pred_log(spark, sf).select(F.col("y_pred").alias("class_id")).distinct()
    named = class_dim(spark).join(used, "class_id", "left_semi")
    return named.select("class_id", capitalize("name").alias("capitalized"), title("name").alias("titled"))


@register("F3_result_record", _priced_cte() + """
SELECT concat('uploads/', strftime(received_at, '%Y%m%d'), '/', session_id, '/', filename) AS image_path,
  filename, concat(upper(left(fruit, 1)), lower(substr(fruit, 2))) AS prediction,
  confidence, price_text AS price
FROM priced""")
def q_f3(spark, sf):
    p = priced_results(spark, sf).withColumn(
        "image_url", F.concat_ws("/", F.lit("uploads"), F.date_format("received_at", "yyyyMMdd"),
                                 "session_id", "filename"))
    return enrich.result_record(p)


@register("F4_results_table", _priced_cte() + """
SELECT filename AS image, fruit,
  concat(CAST(CAST(round(confidence * 10000) AS BIGINT) // 100 AS VARCHAR), '.',
         lpad(CAST(CAST(round(confidence * 10000) AS BIGINT) % 100 AS VARCHAR), 2, '0'), '%') AS confidence,
  price_text AS price, strftime(processed_at, '%H:%M:%S') AS processed
FROM priced""")
def q_f4(spark, sf):
    return enrich.results_table(priced_results(spark, sf))


@register("F5_detection_status", cte("pred_log", "class_dim", "price_dim") + """
SELECT p.event_id,
  CASE WHEN confidence > 0.7 THEN c.name WHEN confidence > 0.5 THEN c.name END AS fruit,
  CASE WHEN confidence > 0.7 THEN coalesce(d.price_text, 'N/A')
       WHEN confidence > 0.5 THEN coalesce(d.price_text, 'N/A') END AS price_text,
  CASE WHEN confidence > 0.7 THEN 'detected' WHEN confidence > 0.5 THEN 'possible'
       ELSE 'uncertain' END AS status
FROM pred_log p LEFT JOIN class_dim c ON p.y_pred = c.class_id
LEFT JOIN (SELECT * FROM price_dim WHERE catalog = 'webcam') d ON lower(c.name) = lower(d.name)""")
def q_f5(spark, sf):
    log = fx.pred_log(spark, sf).select("event_id", "y_pred", "confidence")
    named = enrich.decode_label(log, class_dim(spark), id_col="y_pred")
    priced = enrich.price_lookup(named, price_dim(spark), catalog="webcam")
    return enrich.detection_status(priced, mask=True).select("event_id", "fruit", "price_text", "status")


# --- G: session queries over the prediction log ------------------------------
# The log as the sink writes it: valid, priced predictions.
LOG_CTE = _priced_cte()


@register("G1_session_results", LOG_CTE + """
SELECT filename, fruit, confidence, processed_at,
  concat('uploads/', strftime(received_at, '%Y%m%d'), '/', session_id, '/', filename) AS image_url
FROM priced WHERE session_id = 'u41-20240101'""", ts_cols=('processed_at',))
def q_g1(spark, sf):
    log = priced_results(spark, sf).withColumn(
        "image_url", F.concat_ws("/", F.lit("uploads"), F.date_format("received_at", "yyyyMMdd"),
                                 "session_id", "filename"))
    return sessions.session_results(log, "u41-20240101")


@register("G2_latest_predictions", LOG_CTE + """
SELECT event_id, session_id, filename, fruit, confidence, processed_at
FROM priced ORDER BY processed_at DESC, event_id DESC LIMIT 10""", ts_cols=('processed_at',))
def q_g2(spark, sf):
    log = priced_results(spark, sf).select("event_id", "session_id", "filename", "fruit",
                                           "confidence", "processed_at")
    return sessions.latest(log, 10, tie_col="event_id")


@register("G3_session_stats", LOG_CTE + """
SELECT session_id, count(*) AS total, avg(confidence) AS avg_conf,
  max(processed_at) AS last_processed_at
FROM priced GROUP BY session_id ORDER BY last_processed_at DESC, session_id""", ts_cols=('last_processed_at',))
def q_g3(spark, sf):
    return sessions.session_stats(priced_results(spark, sf))


@register("G4_session_summary", G4_SQL)
def q_g4(spark, sf):
    return sessions.session_summary(priced_results(spark, sf), CLASS_NAMES)


@register("G5_class_distribution", LOG_CTE + """
, counts AS (SELECT session_id, fruit, count(*) AS n FROM priced GROUP BY session_id, fruit)
SELECT * FROM counts WHERE session_id IN (
  SELECT session_id FROM counts WHERE fruit IS NOT NULL GROUP BY session_id HAVING count(*) > 1)""")
def q_g5(spark, sf):
    return sessions.class_distribution(priced_results(spark, sf), ["session_id"])


@register("G5_class_distribution_overall", LOG_CTE + """
SELECT fruit, count(*) AS n FROM priced GROUP BY fruit
HAVING (SELECT count(DISTINCT fruit) FROM priced) > 1""")
def q_g5o(spark, sf):
    return sessions.class_distribution(priced_results(spark, sf), [])


G6_SQL = LOG_CTE + """
, uploads AS (
  SELECT session_id, concat(event_type, '.jpg') AS filename, received_at AS uploaded_at,
    event_id AS upload_id, k AS upload_size_kb FROM pred_log),
firsts AS (
  SELECT session_id, filename, arg_min(uploaded_at, (uploaded_at, upload_id)) AS uploaded_at,
    arg_min(upload_id, (uploaded_at, upload_id)) AS upload_id,
    arg_min(upload_size_kb, (uploaded_at, upload_id)) AS upload_size_kb
  FROM uploads GROUP BY session_id, filename)
SELECT r.event_id, r.session_id, r.filename, r.fruit, f.uploaded_at, f.upload_id, f.upload_size_kb
FROM (SELECT event_id, session_id, concat(event_type, '.jpg') AS filename, fruit FROM priced) r
LEFT JOIN firsts f ON r.session_id = f.session_id AND r.filename = f.filename"""


@register("G6_match_uploads", G6_SQL, ts_cols=('uploaded_at',))
def q_g6(spark, sf):
    log = fx.pred_log(spark, sf)
    uploads = log.select("session_id", F.concat("event_type", F.lit(".jpg")).alias("filename"),
                         F.col("received_at").alias("uploaded_at"), F.col("event_id").alias("upload_id"),
                         F.col("k").alias("upload_size_kb"))
    results = priced_results(spark, sf).select(
        "event_id", "session_id", F.concat("event_type", F.lit(".jpg")).alias("filename"), "fruit")
    return sessions.match_uploads(results, uploads).select(
        "event_id", "session_id", "filename", "fruit", "uploaded_at", "upload_id", "upload_size_kb")


G7_SQL = cte("pred_log") + """
, per_request AS (
  SELECT event_id AS request_id, session_id, received_at,
    CASE WHEN in_time THEN processed_at END AS processed_at,
    CASE WHEN in_time AND is_error THEN 'bad image' END AS error,
    CASE WHEN in_time AND is_error THEN 'error' WHEN in_time THEN 'done' ELSE 'timed out' END AS status
  FROM (SELECT *, processed_at BETWEEN received_at AND received_at + INTERVAL 60 SECOND AS in_time FROM pred_log) AS x)"""


def _g7(spark, sf):
    log = fx.pred_log(spark, sf)
    requests = log.select(F.col("event_id").alias("request_id"), "session_id", "received_at")
    results = log.select(F.col("event_id").alias("request_id"), "processed_at",
                         F.when(F.col("is_error"), F.lit("bad image")).alias("error"))
    return sessions.request_completeness(requests, results)


@register("G7_request_completeness", G7_SQL + """
SELECT request_id, session_id, received_at, processed_at, error, status FROM per_request""", ts_cols=('received_at', 'processed_at'))
def q_g7(spark, sf):
    return _g7(spark, sf).select("request_id", "session_id", "received_at", "processed_at", "error", "status")


@register("G7_session_completeness", G7_SQL + """
SELECT session_id, count(*) AS n_requests,
  count(*) FILTER (WHERE status = 'done') AS n_done,
  count(*) FILTER (WHERE status = 'error') AS n_error,
  count(*) FILTER (WHERE status = 'timed out') AS n_timed_out,
  count(*) FILTER (WHERE status = 'timed out') = 0 AS complete
FROM per_request GROUP BY session_id""")
def q_g7s(spark, sf):
    return sessions.session_completeness(_g7(spark, sf))


@register("G8_session_preview", cte("pred_log") + """
, ranked AS (
  SELECT session_id, filename, row_number() OVER (PARTITION BY session_id ORDER BY received_at, filename) AS pos,
    count(*) OVER (PARTITION BY session_id) AS n FROM pred_log)
SELECT session_id, CAST(pos AS INTEGER) AS pos, filename, greatest(n - 5, 0) AS n_more FROM ranked WHERE pos <= 5""")
def q_g8(spark, sf):
    up = fx.pred_log(spark, sf).select("session_id", "filename", F.col("received_at").alias("uploaded_at"))
    return sessions.session_preview(up, k=5)
