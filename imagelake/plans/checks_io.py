"""Registered queries: catalogue and dataset statistics (A1, H1-H4), messages
(A4, A5, B2), fetch (A6), landing (B1), error log (B5), report JSON (B6) and
augmentation parameters (D15)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from ..dims import CLASS_NAMES, class_dim
from ..operators import datasets as H
from ..operators.augment import apply_flip_bc, augment_params
from ..operators.report import model_report
from ..operators.validate import decode_outcome
from ..oracle import cte
from ..registry import register
from ..session import table
from ..sinks.messages import message_value
from ..sinks.predictions import error_rows
from ..sinks.reports import report_json
from ..sinks.uploads import land_uploads
from ..sources.fetch import image_fetch
from ..sources.messages import parse_messages, type_messages

SPLIT_RE = "string_split_regex(path, '[/\\\\\\\\]')"
CAT_SQL = cte("catalogue") + f"""
, cat AS (SELECT page_id, path, split, {SPLIT_RE}[-2] AS label FROM catalogue)"""


def _cat(spark, sf):
    return H.catalog_from_paths(fx.catalogue(spark, sf))


@register("A1_image_catalog", CAT_SQL + """
SELECT page_id, path, split, label FROM cat""")
def q_a1(spark, sf):
    return _cat(spark, sf).select("page_id", "path", "split", "label")


@register("H1_folder_counts", CAT_SQL + """
SELECT regexp_extract(path, '^(.*)[/\\\\][^/\\\\]*$', 1) AS folder, count(*) AS n_files FROM cat GROUP BY 1""")
def q_h1(spark, sf):
    return H.folder_counts(_cat(spark, sf))


@register("H2_split_stats", CAT_SQL + """
, per AS (SELECT split, count(*) AS n_images, count(DISTINCT label) AS n_labels FROM cat GROUP BY split)
SELECT split, n_images, n_labels, n_images / sum(n_images) OVER () AS share FROM per""")
def q_h2(spark, sf):
    return H.split_stats(_cat(spark, sf))


@register("H3_one_per_class", CAT_SQL + """
SELECT label, arg_min(page_id, path) AS page_id, min(path) AS path, arg_min(split, path) AS split FROM cat
GROUP BY label""")
def q_h3(spark, sf):
    return H.one_per_class(_cat(spark, sf).select("label", "page_id", "path", "split"))


@register("H4_seeded_shuffle", CAT_SQL + """
SELECT page_id, path, md5(concat(path, ':7')) AS shuffle_key FROM cat""")
def q_h4(spark, sf):
    return H.seeded_shuffle(_cat(spark, sf).select("page_id", "path"), "path", seed=7)


# --- messages ---------------------------------------------------------------

MSG_SQL = cte("pred_log") + """
, msgs AS (
  SELECT event_id, concat('https://store.example/uploads/', strftime(received_at, '%Y%m%d'), '/', session_id, '/', filename)
      AS image_url, session_id, filename,
    CASE WHEN event_type = 'error' THEN 'not a time' ELSE strftime(received_at, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp
  FROM pred_log)"""


def _msgs(spark, sf):
    """Request messages built from the log; error events carry a timestamp that
    does not parse (malformed input for A5)."""
    log = fx.pred_log(spark, sf)
    landed = land_uploads(log.withColumnRenamed("received_at", "uploaded_at"), "https://store.example")
    ts = (F.when(F.col("event_type") == "error", F.lit("not a time"))
          .otherwise(F.date_format("uploaded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
    return message_value(landed, keep=["event_id"], ts_text=ts).drop("key")


@register("B2_message_sink", MSG_SQL + """
SELECT event_id, image_url, session_id, filename, timestamp, false AS is_malformed FROM msgs""")
def q_b2(spark, sf):
    parsed = parse_messages(_msgs(spark, sf))
    return parsed.select("event_id", "image_url", "session_id", "filename", "timestamp", "is_malformed")


@register("A4_parse_messages", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  json_extract(props, '$.k') IS NULL AS is_malformed FROM events""")
def q_a4(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("props").alias("value"))
    p = parse_messages(ev, T.StructType([T.StructField("k", T.IntegerType())]))
    return p.select("event_id", "k", "is_malformed")


@register("A5_type_messages", MSG_SQL + """
SELECT event_id, timestamp, try_cast(timestamp AS TIMESTAMP) AS received_at FROM msgs""", ts_cols=('received_at',))
def q_a5(spark, sf):
    parsed = parse_messages(_msgs(spark, sf))
    return type_messages(parsed).select("event_id", "timestamp", "received_at")


@register("B1_land_uploads", cte("pred_log") + """
SELECT event_id, strftime(received_at, '%Y%m%d') AS upload_date,
  concat('uploads/', strftime(received_at, '%Y%m%d'), '/', session_id, '/', filename) AS object_key,
  concat('https://store.example/uploads/', strftime(received_at, '%Y%m%d'), '/', session_id, '/', filename) AS image_url
FROM pred_log""")
def q_b1(spark, sf):
    log = fx.pred_log(spark, sf).select("event_id", "session_id", "filename",
                                        F.col("received_at").alias("uploaded_at"))
    return land_uploads(log, "https://store.example/").select("event_id", "upload_date", "object_key", "image_url")


@register("A6_image_fetch", cte("requests", "images_found") + """
SELECT r.object_id, r.filename, i.height IS NOT NULL AS found,
  CASE WHEN i.height IS NULL THEN 'not found' END AS fetch_error
FROM requests r LEFT JOIN images_found i ON r.object_id = i.object_id""")
def q_a6(spark, sf):
    f = image_fetch(fx.requests(spark, sf), fx.images_found(spark, sf), key="object_id")
    return f.select("object_id", "filename", F.col("height").isNotNull().alias("found"), "fetch_error")


@register("B5_error_sink", cte("outcomes") + """
SELECT sha256(concat_ws(chr(1), session_id, filename,
    concat('uploads/', strftime(received_at, '%Y%m%d'), '/', session_id, '/', filename),
    CAST(epoch_us(received_at) AS VARCHAR))) AS id,
  session_id, filename, split_part(outcome, '|', 2) AS error
FROM outcomes WHERE split_part(outcome, '|', 1) = 'error'""")
def q_b5(spark, sf):
    log = fx.with_outcome(fx.pred_log(spark, sf), class_dim(spark))
    typed = decode_outcome(log.drop("confidence")).withColumn(
        "image_url", F.concat_ws("/", F.lit("uploads"), F.date_format("received_at", "yyyyMMdd"),
                                 "session_id", "filename"))
    return error_rows(typed).select("id", "session_id", "filename", "error")


@register("B6_report_sink", cte("eval") + """
SELECT run_id, sum(CAST(y_true = y_pred AS BIGINT)) / count(*) AS test_accuracy,
  count(*) AS predictions_total, quantile_cont(confidence, 0.5) AS conf_median,
  CAST(15 AS BIGINT) AS n_per_class
FROM eval GROUP BY run_id""")
def q_b6(spark, sf):
    rep = report_json(model_report(fx.eval_rows(spark, sf), fx.history(spark, sf), CLASS_NAMES,
                                   REPORT_CONFIG))
    j = F.col("value")
    return rep.select(
        "run_id",
        F.get_json_object(j, "$.performance_metrics.test.accuracy").cast("double").alias("test_accuracy"),
        F.get_json_object(j, "$.performance_metrics.test.predictions_total").cast("long").alias("predictions_total"),
        F.get_json_object(j, "$.statistical_analysis.confidence_scores.median").cast("double").alias("conf_median"),
        F.size(F.from_json(F.get_json_object(j, "$.statistical_analysis.per_class_accuracy"),
                           "map<string,double>")).cast("long").alias("n_per_class"))


# fixed values: descriptive sections of the model report.
REPORT_CONFIG = {
    "model_info": {"name": "fruit_head", "version": "1.0", "architecture": "frozen base + dense head",
                   "framework": "Spark ML / NumPy"},
    "training_config": {"epochs": 10, "batch_size": 32, "optimizer": "adam",
                        "loss_function": "categorical_crossentropy", "metrics": ["accuracy"],
                        "early_stopping": {"monitor": "val_loss", "patience": 3, "restore_best_weights": True}},
    "model_architecture": {"base_trainable": False, "pooling": "avg",
                           "custom_layers": [{"type": "Dense", "units": 128, "activation": "relu"},
                                             {"type": "Dense", "units": 128, "activation": "relu"},
                                             {"type": "Dense", "units": 15, "activation": "softmax"}]},
}


# --- D15: augmentation parameters and the expression part -------------------

U = """CAST(('0x' || substr(md5(concat_ws(':', CAST(vec_id AS VARCHAR), CAST(variant AS VARCHAR), '3', '{slot}')), 1, 8))
  AS BIGINT) / CAST(4294967296 AS DOUBLE)"""


def _u(slot):
    return U.format(slot=slot)


AUG_SQL = cte("pix8") + f"""
, v AS (SELECT *, CAST(variant AS INTEGER) AS variant_ FROM pix8, range(1, 4) t(variant) WHERE vec_id % 10 >= 2),
p AS (
  SELECT vec_id, variant_ AS variant, pixels, height, width, n_channels,
    {_u('flip')} < 0.5 AS flip,
    CASE WHEN {_u('rotate_on')} < 0.7 THEN ({_u('rotate')} * 2 - 1) * 15.0 ELSE 0.0 END AS angle,
    CASE WHEN {_u('bc_on')} < 0.5 THEN ({_u('brightness')} * 2 - 1) * 0.2 ELSE 0.0 END AS brightness,
    CASE WHEN {_u('bc_on')} < 0.5 THEN ({_u('contrast')} * 2 - 1) * 0.2 ELSE 0.0 END AS contrast
  FROM v)"""


def _aug(spark, sf):
    p8 = fx.pix8(spark, sf).withColumn(
        "split", F.when(F.col("vec_id") % 10 == 0, "test").when(F.col("vec_id") % 10 == 1, "validation")
        .otherwise("train"))
    return augment_params(p8, 3, seed=3)


@register("D15_augment_params", AUG_SQL + """
SELECT vec_id, variant, flip, angle, brightness, contrast FROM p""")
def q_d15(spark, sf):
    return _aug(spark, sf).select(F.col("vec_id"), F.col("variant").cast("int").alias("variant"),
                                  "flip", "angle", "brightness", "contrast")


@register("D15_augment_flip_bc", AUG_SQL + """
SELECT vec_id, variant, list_transform(
    CASE WHEN flip THEN list_transform(range(0, 64), lambda j: pixels[(j // 8) * 8 + (7 - j % 8) + 1]) ELSE pixels END,
    lambda x: least(greatest(CAST(x AS DOUBLE) * (1 + contrast) + CAST(255 AS DOUBLE) * brightness,
      CAST(0 AS DOUBLE)), CAST(255 AS DOUBLE))) AS pixels
FROM p""")
def q_d15b(spark, sf):
    return apply_flip_bc(_aug(spark, sf)).select(
        "vec_id", F.col("variant").cast("int").alias("variant"), "pixels")


# --- A7 and E6 (batch core of the scoring stream) ----------------------------

@register("A7_predictions_scan", """
SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'""")
def q_a7(spark, sf):
    """Scan of the valid rows with the predicate pushed to Parquet (PushedFilters)."""
    from ..sources.fetch import predictions_scan
    df = predictions_scan(spark, f"{sf}/events.parquet", predicate=F.col("event_type") != "error")
    return df.select("event_id", "user_id", "event_type", "value")


def _e6_inputs(spark, sf):
    """Requests: one message per log row, pointing at picture ``7 * user_id``;
    landed pictures: the 8x8x3 pix3 pictures (ids from the embedding count on
    are never landed, so some requests miss)."""
    log = fx.pred_log(spark, sf)
    url = F.concat(F.lit("https://store.example/uploads/20240101/cam/"),
                   (F.col("user_id") * 7).cast("string"), F.lit(".png"))
    msgs = log.select("event_id", url.alias("image_url"), "session_id", "filename", "received_at")
    vals = message_value(msgs, ts_col="received_at", keep=["event_id"]).drop("key")
    reqs = type_messages(parse_messages(vals))
    landed = fx.pix3(spark, sf).select(
        F.lit("20240101").alias("upload_date"),
        F.concat(F.lit("uploads/20240101/cam/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("object_key"),
        "height", "width", "n_channels", "pixels")
    return reqs, landed


E6_SCORES = """list_transform(range(0, 15), lambda k: list_reduce(list_transform(pixels, lambda x, j:
    x * (((7 * (j - 1) + 13 * k) % 17 - 8) / CAST(8 AS DOUBLE))), lambda a, y: a + y, CAST(0 AS DOUBLE)))"""


@register("E6_score_requests", cte("pred_log", "pix3", "class_dim") + f"""
, reqs AS (SELECT event_id, session_id, filename, CAST(user_id * 7 AS BIGINT) AS vec_id FROM pred_log),
fetched AS (SELECT r.*, p.pixels FROM reqs r LEFT JOIN pix3 p ON r.vec_id = p.vec_id),
scored AS (
  SELECT event_id, list_transform(e, lambda x: x / list_reduce(e, lambda a, y: a + y, CAST(0 AS DOUBLE))) AS probs
  FROM (SELECT event_id, list_transform(s, lambda x: exp(x - list_max(s))) AS e
        FROM (SELECT event_id, {E6_SCORES} AS s FROM fetched WHERE pixels IS NOT NULL AND len(pixels) = 192)))
SELECT f.session_id, f.filename, c.name AS fruit,
  round(list_max(s.probs), 6) AS confidence,
  CASE WHEN f.pixels IS NULL THEN 'not found' WHEN len(f.pixels) <> 192 THEN 'bad shape' END AS error
FROM fetched f LEFT JOIN scored s ON f.event_id = s.event_id
LEFT JOIN class_dim c ON c.class_id = CAST(list_position(s.probs, list_max(s.probs)) - 1 AS INTEGER)""")
def q_e6(spark, sf):
    """The per-batch core of the scoring stream (E6) on whole tables: fetch (A6),
    shape check (D7), score (E1), argmax (E3), label (E4)."""
    from ..operators.scoring import rule_head
    from ..streaming.scoring import score_requests
    reqs, landed = _e6_inputs(spark, sf)
    out = score_requests(reqs, landed, rule_head(192, 15), class_dim(spark), (8, 8, 3))
    return out.select("session_id", "filename", "fruit", F.round("confidence", 6).alias("confidence"), "error")


def _u_seed(slot: str, seed: int) -> str:
    return (f"CAST(('0x' || substr(md5(concat_ws(':', CAST(vec_id AS VARCHAR), CAST(variant AS VARCHAR), "
            f"'{seed}', '{slot}')), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)")


def _floor_mod(a: str, b: str) -> str:
    """NumPy's ``%`` on doubles: fmod, then shifted into the divisor's sign."""
    return f"(CASE WHEN fmod({a}, {b}) < 0 THEN fmod({a}, {b}) + {b} ELSE fmod({a}, {b}) END)"


D13_SQL = cte("pix3") + f"""
, params AS (
  SELECT vec_id, CAST(variant AS INTEGER) AS variant, pixels,
    CASE WHEN {_u_seed('rotate_on', 5)} < 0.7 THEN ({_u_seed('rotate', 5)} * 2 - 1) * 15.0 ELSE 0.0 END AS angle
  FROM pix3, range(1, 3) t(variant)),
m AS (SELECT *, cos(angle * (pi() / 180.0)) AS ca, sin(angle * (pi() / 180.0)) AS sa FROM params)
SELECT vec_id, variant, angle,
  list_transform(range(0, 192), lambda j: pixels[(
      CAST(least(greatest(round_even(ca * (j // 24) - sa * ((j // 3) % 8) + (3.5 - ca * 3.5 + sa * 3.5), 0), 0), 7)
           AS BIGINT) * 8
    + CAST(least(greatest(round_even(sa * (j // 24) + ca * ((j // 3) % 8) + (3.5 - sa * 3.5 - ca * 3.5), 0), 0), 7)
           AS BIGINT)) * 3 + j % 3 + 1]) AS pixels
FROM m"""


@register("D13_affine_warp", D13_SQL)
def q_d13(spark, sf):
    """Seeded rotations of the 8x8x3 pictures (NumPy inverse map per Arrow batch)."""
    from ..operators.augment import affine
    p3 = fx.pix3(spark, sf).withColumn("split", F.lit("train"))
    params = augment_params(p3, 2, seed=5)
    return affine(params, "angle").select("vec_id", F.col("variant").cast("int").alias("variant"), "angle", "pixels")


D14_SQL = cte("pix3") + f"""
, params AS (
  SELECT vec_id, CAST(variant AS INTEGER) AS variant, pixels,
    CASE WHEN {_u_seed('hsv_on', 6)} < 0.5 THEN ({_u_seed('hue', 6)} * 2 - 1) * 10.0 ELSE 0.0 END AS hue,
    CASE WHEN {_u_seed('hsv_on', 6)} < 0.5 THEN ({_u_seed('sat', 6)} * 2 - 1) * 20.0 ELSE 0.0 END AS sat,
    CASE WHEN {_u_seed('hsv_on', 6)} < 0.5 THEN ({_u_seed('val', 6)} * 2 - 1) * 10.0 ELSE 0.0 END AS val
  FROM pix3, range(1, 3) t(variant)),
px AS (
  SELECT vec_id, variant, hue, sat, val, p,
    pixels[3 * p + 1] AS r0, pixels[3 * p + 2] AS g0, pixels[3 * p + 3] AS b0,
    pixels[3 * p + 1] / 255.0 AS r, pixels[3 * p + 2] / 255.0 AS g, pixels[3 * p + 3] / 255.0 AS b
  FROM params, range(0, 64) q(p)),
h1 AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS c FROM px),
h2 AS (SELECT *, CASE WHEN v > 0 THEN c / v ELSE 0.0 END AS s,
         CASE WHEN c > 0 THEN c ELSE 1.0 END AS safe FROM h1),
h3 AS (SELECT *, CASE WHEN c > 0 THEN (CASE WHEN v = r THEN {_floor_mod('(g - b) / safe', '6.0')}
                                          WHEN v = g THEN (b - r) / safe + 2
                                          ELSE (r - g) / safe + 4 END) * 60.0 ELSE 0.0 END AS h FROM h2),
sh AS (SELECT *, {_floor_mod('h + hue', '360.0')} AS hh,
         least(greatest(s * 255.0 + sat, 0.0), 255.0) AS ss,
         least(greatest(v * 255.0 + val, 0.0), 255.0) AS vv FROM h3),
b1 AS (SELECT *, fmod(hh, 360.0) AS h4, ss / 255.0 AS s4, vv / 255.0 AS v4 FROM sh),
b2 AS (SELECT *, v4 * s4 AS cc, h4 / 60.0 AS hp FROM b1),
b3 AS (SELECT *, cc * (1 - abs(fmod(hp, 2.0) - 1)) AS xx, CAST(floor(hp) AS INTEGER) % 6 AS sector,
         v4 - cc AS m FROM b2),
out AS (
  SELECT vec_id, variant, hue, sat, val, p,
    CASE WHEN hue = 0 AND sat = 0 AND val = 0 THEN r0 ELSE least(greatest(((CASE sector WHEN 0 THEN cc
      WHEN 1 THEN xx WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 WHEN 4 THEN xx ELSE cc END) + m) * 255.0, 0.0), 255.0) END AS ro,
    CASE WHEN hue = 0 AND sat = 0 AND val = 0 THEN g0 ELSE least(greatest(((CASE sector WHEN 0 THEN xx
      WHEN 1 THEN cc WHEN 2 THEN cc WHEN 3 THEN xx ELSE 0.0 END) + m) * 255.0, 0.0), 255.0) END AS go,
    CASE WHEN hue = 0 AND sat = 0 AND val = 0 THEN b0 ELSE least(greatest(((CASE sector WHEN 0 THEN 0.0
      WHEN 1 THEN 0.0 WHEN 2 THEN xx WHEN 3 THEN cc WHEN 4 THEN cc ELSE xx END) + m) * 255.0, 0.0), 255.0) END AS bo
  FROM b3)
SELECT vec_id, variant, hue, sat, val, flatten(list([ro, go, bo] ORDER BY p)) AS pixels
FROM out GROUP BY vec_id, variant, hue, sat, val"""


@register("D14_hsv_shift", D14_SQL)
def q_d14(spark, sf):
    """Seeded hue / saturation / value shifts of the 8x8x3 pictures (NumPy per Arrow batch)."""
    from ..operators.augment import hsv_shift
    p3 = fx.pix3(spark, sf).withColumn("split", F.lit("train"))
    params = augment_params(p3, 2, seed=6)
    return hsv_shift(params).select("vec_id", F.col("variant").cast("int").alias("variant"), "hue", "sat", "val",
                                    "pixels")
