"""Sampled inference over frame sequences (E7, batch form).

The camera scores every n-th frame (by its frame counter) and shows the last
result on the frames in between; an error result is carried the same way, also
over scored frames that are missing. Only blocks of ``n`` frames, one row each, are
carried (``functions.carry``: fixed ranges, one carried row per range); every frame
then joins its block, so a stream holding a third of all frames spreads over many
tasks. Frames without a stream or a counter stay, without a result. The streaming
form lives in ``streaming.frames``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.carry import carry_forward

SAMPLE_EVERY = 10  # fixed value: the live view scores every 10th frame (3 in the desktop view)


def sampled_inference(frames: DataFrame, n: int = SAMPLE_EVERY,
                      result_cols: tuple[str, ...] = ("y_pred", "confidence", "is_error")) -> DataFrame:
    """Every frame with the result of the last scored frame (``source_frame``) and
    ``scored`` telling whether it was scored itself."""
    block = F.floor(F.col("frame_no") / n).cast("long")
    own = F.struct(F.col("frame_no").alias("source_frame"), *result_cols)
    known = F.col("stream_id").isNotNull() & F.col("frame_no").isNotNull()
    # the scored frame of a block, if any, is its first one
    blocks = frames.where(known).groupBy("stream_id", block.alias("_block")).agg(
        F.max(F.when(F.col("frame_no") % n == 0, own)).alias("_own"))
    blocks = carry_forward(blocks, ["stream_id"], ["_block"], "_own", "_r").select("stream_id", "_block", "_r")
    base = frames.where(known).select("stream_id", "frame_no", "ts", block.alias("_block"))
    shown = base.join(blocks, ["stream_id", "_block"]).select(
        "stream_id", F.col("_r.source_frame").alias("source_frame"), "frame_no", "ts",
        *[F.col(f"_r.{c}").alias(c) for c in result_cols],
        F.coalesce(F.col("frame_no") == F.col("_r.source_frame"), F.lit(False)).alias("scored"))
    none = [F.lit(None).cast(frames.schema[c].dataType).alias(c) for c in result_cols]
    return shown.unionByName(frames.where(~known).select(
        "stream_id", F.lit(None).cast("long").alias("source_frame"), "frame_no", "ts", *none, F.lit(False).alias("scored")))
