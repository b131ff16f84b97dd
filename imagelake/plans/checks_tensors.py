"""Registered queries: picture arithmetic (D1-D12), scoring (E1-E3, E5) and
sampled inference (E7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..dims import CLASS_NAMES, class_dim
from ..functions import probs as P
from ..functions import tensors as D
from ..operators.enrich import decode_label
from ..operators.frames import sampled_inference
from ..operators.scoring import extract_features, rule_head, rule_mlp, score_batch
from ..oracle import cte
from ..registry import register
from ..session import table

MEAN = "([0.485, 0.456, 0.406]::DOUBLE[])"
STD = "([0.229, 0.224, 0.225]::DOUBLE[])"


@register("D1_scale_unit", cte("pix8") + """
SELECT vec_id, list_transform(pixels, lambda x: CAST(x AS DOUBLE) / CAST(255 AS DOUBLE)) AS scaled FROM pix8""")
def q_d1(spark, sf):
    return fx.pix8(spark, sf).select("vec_id", D.scale_unit("pixels").alias("scaled"))


@register("D2_scale_signed", cte("pix8") + """
SELECT vec_id, list_transform(pixels, lambda x: CAST(x AS DOUBLE) / CAST(127.5 AS DOUBLE) - CAST(1 AS DOUBLE))
  AS scaled FROM pix8""")
def q_d2(spark, sf):
    return fx.pix8(spark, sf).select("vec_id", D.scale_signed("pixels").alias("scaled"))


STD_SQL = f"""list_transform(pixels, lambda x, i: (CAST(x AS DOUBLE) / CAST(255 AS DOUBLE) - {MEAN}[(i - 1) % 3 + 1])
    / {STD}[(i - 1) % 3 + 1])"""


@register("D3_standardize", cte("pix3") + f"""
SELECT vec_id, {STD_SQL} AS standardized FROM pix3""")
def q_d3(spark, sf):
    return fx.pix3(spark, sf).select("vec_id", D.standardize("pixels").alias("standardized"))


@register("D4_destandardize", cte("pix3") + f"""
SELECT vec_id, list_transform(s, lambda v, i: least(greatest(v * {STD}[(i - 1) % 3 + 1] + {MEAN}[(i - 1) % 3 + 1],
    CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE))) AS restored
FROM (SELECT vec_id, {STD_SQL} AS s FROM pix3)""")
def q_d4(spark, sf):
    return fx.pix3(spark, sf).select("vec_id", D.destandardize(D.standardize("pixels")).alias("restored"))


@register("D5_to_rgb", cte("pix3") + """
SELECT vec_id, n_channels, list_transform(range(0, height * width * 3), lambda j:
    CASE WHEN n_channels = 1 THEN pixels[j // 3 + 1] ELSE pixels[(j // 3) * n_channels + 2 - j % 3 + 1] END) AS rgb
FROM (SELECT * FROM pix3 UNION ALL SELECT * FROM pix8)""")
def q_d5(spark, sf):
    both = fx.pix3(spark, sf).unionByName(fx.pix8(spark, sf))
    return both.select("vec_id", "n_channels", D.to_rgb("pixels", "height", "width", "n_channels").alias("rgb"))


@register("D6_resize_nearest", cte("pix3") + """
SELECT vec_id, n_channels,
  list_transform(range(0, 5 * 6 * n_channels), lambda j:
    pixels[(((j // (6 * n_channels)) * height // 5) * width + ((j // n_channels) % 6) * width // 6) * n_channels
           + j % n_channels + 1]) AS resized
FROM (SELECT * FROM pix3 UNION ALL SELECT * FROM pix8)""")
def q_d6(spark, sf):
    both = fx.pix3(spark, sf).unionByName(fx.pix8(spark, sf))
    return both.select("vec_id", "n_channels",
                       D.resize_nearest("pixels", "height", "width", "n_channels", 5, 6).alias("resized"))


@register("D7_shape_check", cte("pix3") + """
SELECT vec_id, n_channels, height > 0 AND len(pixels) = height * width * n_channels AS ok,
  len(pixels) = 8 * 8 * 3 AS is_8x8x3
FROM (SELECT * FROM pix3 UNION ALL SELECT * FROM pix8)""")
def q_d7(spark, sf):
    both = fx.pix3(spark, sf).unionByName(fx.pix8(spark, sf))
    return both.select("vec_id", "n_channels", D.has_shape("pixels", "height", "width", "n_channels").alias("ok"),
                       D.has_shape("pixels", 8, 8, 3).alias("is_8x8x3"))


@register("D8_minmax_normalize", cte("slices") + """
SELECT vec_id, slice_id, CASE WHEN hi > lo THEN list_transform(vals, lambda x: (CAST(x AS DOUBLE) - lo) / (hi - lo))
  END AS normalized
FROM (SELECT *, CAST(list_min(vals) AS DOUBLE) AS lo, CAST(list_max(vals) AS DOUBLE) AS hi FROM slices)""")
def q_d8(spark, sf):
    return fx.slices(spark, sf).select("vec_id", "slice_id", D.minmax("vals").alias("normalized"))


VAR_SQL = """(SELECT *, list_reduce(list_transform(vals, lambda x: (CAST(x AS DOUBLE) - mean) * (CAST(x AS DOUBLE) - mean)),
    lambda a, x: a + x, CAST(0 AS DOUBLE)) / len(vals) AS var
  FROM (SELECT *, list_reduce(vals, lambda a, x: a + CAST(x AS DOUBLE), CAST(0 AS DOUBLE)) / len(vals) AS mean
        FROM slices))"""


@register("D9_variance_tier", cte("slices") + f"""
SELECT vec_id, slice_id, var,
  CASE WHEN var > 0.01 THEN 'active' WHEN var > 0.005 THEN 'moderate' ELSE 'soft' END AS tier
FROM {VAR_SQL}""")
def q_d9(spark, sf):
    s = fx.slices(spark, sf)
    return s.select("vec_id", "slice_id", D.var_pop("vals").alias("var"), D.variance_tier("vals").alias("tier"))


@register("D10_pool_channels", cte("pix3") + """
SELECT vec_id,
  list_transform(range(0, 3), lambda k: list_reduce(list_filter(pixels, lambda x, i: (i - 1) % 3 = k),
      lambda a, x: a + x, CAST(0 AS DOUBLE)) / len(list_filter(pixels, lambda x, i: (i - 1) % 3 = k))) AS avg_pool,
  list_transform(range(0, 3), lambda k: list_max(list_filter(pixels, lambda x, i: (i - 1) % 3 = k))) AS max_pool,
  list_transform(range(0, 64), lambda p: list_reduce(pixels[p * 3 + 1 : p * 3 + 3],
      lambda a, x: a + x, CAST(0 AS DOUBLE)) / 3) AS channel_mean
FROM pix3""")
def q_d10(spark, sf):
    return fx.pix3(spark, sf).select(
        "vec_id", D.pool_channels("pixels", "n_channels", "avg").alias("avg_pool"),
        D.pool_channels("pixels", "n_channels", "max").alias("max_pool"),
        D.channel_mean("pixels", "height", "width", "n_channels").alias("channel_mean"))


@register("D11_flip_horizontal", cte("pix3") + """
SELECT vec_id, n_channels, list_transform(range(0, len(pixels)), lambda j:
    pixels[((j // (width * n_channels)) * width + (width - 1 - (j // n_channels) % width)) * n_channels
           + j % n_channels + 1]) AS flipped
FROM (SELECT * FROM pix3 UNION ALL SELECT * FROM pix8)""")
def q_d11(spark, sf):
    both = fx.pix3(spark, sf).unionByName(fx.pix8(spark, sf))
    return both.select("vec_id", "n_channels", D.flip_h("pixels", "height", "width", "n_channels").alias("flipped"))


@register("D12_brightness_contrast", cte("pix8") + """
SELECT vec_id, list_transform(pixels, lambda x: least(greatest(CAST(x AS DOUBLE) * (1 + c) + CAST(255 AS DOUBLE) * b,
    CAST(0 AS DOUBLE)), CAST(255 AS DOUBLE))) AS adjusted
FROM (SELECT *, ((vec_id % 9) - 4) / CAST(20 AS DOUBLE) AS b, ((vec_id % 7) - 3) / CAST(15 AS DOUBLE) AS c FROM pix8)""")
def q_d12(spark, sf):
    p = fx.pix8(spark, sf)
    b = ((F.col("vec_id") % 9) - 4) / 20.0
    c = ((F.col("vec_id") % 7) - 3) / 15.0
    return p.select("vec_id", D.brightness_contrast("pixels", b, c).alias("adjusted"))


# --- E: scoring --------------------------------------------------------------

@register("E3_argmax_confidence", cte("raw_scores") + """
SELECT item_id, CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS class_id,
  list_max(scores) AS confidence FROM raw_scores""")
def q_e3(spark, sf):
    return P.argmax_confidence(fx.raw_scores(spark, sf), "scores").select("item_id", "class_id", "confidence")


SOFTMAX_SQL = """(SELECT item_id, list_transform(e, lambda x: x / list_reduce(e, lambda a, y: a + y, CAST(0 AS DOUBLE))) AS probs
  FROM (SELECT item_id, list_transform(scores, lambda x: exp(x - list_max(scores))) AS e FROM {src}))"""


@register("E3_softmax_confidence", cte("raw_scores") + """
SELECT item_id, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS class_id,
  round(list_max(probs), 9) AS confidence FROM """ + SOFTMAX_SQL.format(src="raw_scores"))
def q_e3s(spark, sf):
    s = fx.raw_scores(spark, sf).select("item_id", P.softmax("scores").alias("probs"))
    return P.argmax_confidence(s, "probs").select(
        "item_id", "class_id", F.round("confidence", 9).alias("confidence"))


@register("E5_topk_labels", cte("raw_scores", "class_dim") + """
, ranked AS (
  SELECT item_id, CAST(i - 1 AS INTEGER) AS class_id, s AS score,
    row_number() OVER (PARTITION BY item_id ORDER BY s DESC, i ASC) AS rank
  FROM (SELECT item_id, unnest(scores) AS s, unnest(range(1, 11)) AS i FROM raw_scores))
SELECT r.item_id, CAST(r.rank AS INTEGER) AS rank, r.class_id, r.score, c.name
FROM ranked r LEFT JOIN class_dim c ON r.class_id = c.class_id WHERE r.rank <= 5""")
def q_e5(spark, sf):
    top = P.topk(fx.raw_scores(spark, sf).select("item_id", "scores"), "scores", 5)
    return decode_label(top, class_dim(spark), id_col="class_id", out_col="name")


_E1_SCORES = """list_transform(range(0, 10), lambda k: list_reduce(list_transform(embedding, lambda x, j:
    CAST(x AS DOUBLE) * (((7 * (j - 1) + 13 * k) % 17 - 8) / CAST(8 AS DOUBLE))), lambda a, y: a + y, CAST(0 AS DOUBLE)))"""


@register("E1_score_batch", f"""
SELECT item_id, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS class_id,
  round(list_max(probs), 6) AS confidence
FROM {SOFTMAX_SQL.format(src=f"(SELECT vec_id AS item_id, {_E1_SCORES} AS scores FROM embeddings)")}""")
def q_e1(spark, sf):
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("features"))
    scored = score_batch(emb, rule_head(64, 10), "features", keep=["item_id"])
    return scored.select("item_id", "class_id", F.round("confidence", 6).alias("confidence"))


E2_FEATURES = """CAST(list_transform(range(0, 16), lambda h: greatest(list_reduce(list_transform(embedding, lambda x, j:
    CAST(x AS DOUBLE) * (((5 * (j - 1) + 3 * h) % 11 - 5) / CAST(10 AS DOUBLE))), lambda a, y: a + y, CAST(0 AS DOUBLE)),
    CAST(0 AS DOUBLE))) AS FLOAT[])"""


@register("E2_extract_features", f"""
SELECT vec_id, {E2_FEATURES} AS features FROM embeddings""")
def q_e2(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("pixels"))
    # exact sums: the hidden layer adds its inputs in order, as the SQL twin does
    return extract_features(emb, rule_mlp(64, 16, len(CLASS_NAMES), exact_sums=True), upto=1, keep=["vec_id"])


@register("E7_gapped_frames", cte("pred_log") + """
, gapped AS (SELECT concat('cam', CAST(user_id AS VARCHAR)) AS stream_id, CASE WHEN NOT is_error THEN event_id END AS frame_no,
    received_at AS ts, y_pred, confidence, is_error FROM pred_log)
SELECT stream_id, frame_no, ts, coalesce(last_value(CASE WHEN frame_no % 10 = 0 THEN frame_no END IGNORE NULLS) OVER w, -1) AS source_frame,
  coalesce(last_value(CASE WHEN frame_no % 10 = 0 THEN y_pred END IGNORE NULLS) OVER w, -1) AS y_pred,
  last_value(CASE WHEN frame_no % 10 = 0 THEN confidence END IGNORE NULLS) OVER w AS confidence, frame_no % 10 = 0 AS scored
FROM gapped WHERE frame_no IS NOT NULL
WINDOW w AS (PARTITION BY stream_id ORDER BY frame_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
UNION ALL SELECT stream_id, -1, ts, -1, -1, NULL, false FROM gapped WHERE frame_no IS NULL""", ts_cols=("ts",))
def q_e7_gaps(spark, sf):
    """A camera's counter runs over all cameras, so most scored frames are missing; errors have lost it."""
    log = fx.pred_log(spark, sf)
    gapped = log.select(F.concat(F.lit("cam"), F.col("user_id").cast("string")).alias("stream_id"),
                        F.when(~F.col("is_error"), F.col("event_id")).alias("frame_no"), F.col("received_at").alias("ts"),
                        "y_pred", "confidence", "is_error")
    minus = lambda c: F.coalesce(c, F.lit(-1)).alias(c)
    return sampled_inference(gapped, 10).select(
        "stream_id", minus("frame_no"), "ts", minus("source_frame"), minus("y_pred"), "confidence", "scored")


@register("E7_sampled_inference", cte("frames") + """
SELECT stream_id, frame_no, ts, CAST(floor(frame_no / 10) * 10 AS BIGINT) AS source_frame,
  last_value(CASE WHEN frame_no % 10 = 0 THEN y_pred END IGNORE NULLS) OVER w AS y_pred,
  last_value(CASE WHEN frame_no % 10 = 0 THEN confidence END IGNORE NULLS) OVER w AS confidence,
  last_value(CASE WHEN frame_no % 10 = 0 THEN is_error END IGNORE NULLS) OVER w AS is_error,
  frame_no % 10 = 0 AS scored
FROM frames
WINDOW w AS (PARTITION BY stream_id ORDER BY frame_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ts_cols=('ts',))
def q_e7(spark, sf):
    return sampled_inference(fx.frames(spark, sf), 10)


@register("E8_train_head")
def q_e8(spark, sf):
    """Train the 128-128 head on the embedding vectors (Spark ML, distributed
    L-BFGS) and score every row; rows-only check (labels are not learnable)."""
    from ..operators.training import head_predictions, train_head
    emb = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("features"), "label")
    model, x = train_head(emb, hidden=(128, 128), n_classes=10, max_iter=15, seed=0)
    return head_predictions(model, x, ["item_id", "label"])


def _bilinear_sql(h: int, w: int, c: int, oh: int, ow: int) -> str:
    """DuckDB text of the bilinear resize for fixed shapes (same operation order)."""
    fy = f"least(greatest(((CAST(j // {ow * c} AS DOUBLE) + 0.5) * {h}) / {oh} - 0.5, CAST(0 AS DOUBLE)), {h - 1})"
    fx = f"least(greatest(((CAST((j // {c}) % {ow} AS DOUBLE) + 0.5) * {w}) / {ow} - 0.5, CAST(0 AS DOUBLE)), {w - 1})"
    y0, x0 = f"CAST(floor({fy}) AS BIGINT)", f"CAST(floor({fx}) AS BIGINT)"
    y1, x1 = f"least({y0} + 1, {h - 1})", f"least({x0} + 1, {w - 1})"
    wy, wx = f"({fy} - {y0})", f"({fx} - {x0})"

    def at(y, x):
        return f"pixels[({y} * {w} + {x}) * {c} + j % {c} + 1]"

    return (f"list_transform(range(0, {oh * ow * c}), lambda j: "
            f"({at(y0, x0)} * (1 - {wx}) + {at(y0, x1)} * {wx}) * (1 - {wy}) + "
            f"({at(y1, x0)} * (1 - {wx}) + {at(y1, x1)} * {wx}) * {wy})")


@register("D6_resize_bilinear", cte("pix3") + f"""
SELECT vec_id, 6 AS height, 5 AS width, 3 AS n_channels, {_bilinear_sql(8, 8, 3, 6, 5)} AS pixels FROM pix3""")
def q_d6b(spark, sf):
    """Bilinear resize of the 8x8x3 pictures to 6x5 (NumPy per Arrow batch; the SQL
    engine covers nearest-neighbour only)."""
    from ..operators.resize import prepare_pictures
    return prepare_pictures(fx.pix3(spark, sf).select("vec_id", "height", "width", "n_channels", "pixels"),
                            ["resize"], (6, 5), engine="numpy", bilinear=True)
