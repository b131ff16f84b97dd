"""Decode pictures into pixel arrays (A2).

Decoding runs in the JVM through Spark's ``image`` source, in parallel over
files; the raw bytes (BGR / BGRA / grey, row-major) become ``ARRAY<FLOAT>`` in an
Arrow-batched pandas UDF (``np.frombuffer``), the only Python step.
Undecodable files keep ``height = -1`` and null pixels so validation (C4) can
report them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import norm_path
from ..functions.tensors import to_rgb


@F.pandas_udf(T.ArrayType(T.FloatType()))
def bytes_to_floats(data: pd.Series) -> pd.Series:
    """uint8 bytes -> float32 values, one vector per row (Arrow batches)."""
    return data.map(lambda b: None if b is None or len(b) == 0 else np.frombuffer(b, dtype=np.uint8)
                    .astype(np.float32))


def image_scan(spark: SparkSession, root: str, drop_invalid: bool = False, rgb: bool = True,
               glob: str | None = None) -> DataFrame:
    """``(path, height, width, n_channels, mode, pixels)`` for every picture under
    ``root``; with ``rgb`` the pixels are converted to 3-channel RGB (D5)."""
    r = spark.read.format("image").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if drop_invalid:
        r = r.option("dropInvalid", "true")
    img = r.load(root).select(
        norm_path("image.origin").alias("path"), F.col("image.height").alias("height"),
        F.col("image.width").alias("width"), F.col("image.nChannels").alias("n_channels"),
        F.col("image.mode").alias("mode"), F.col("image.data").alias("_data"))
    img = img.withColumn("pixels", F.when(F.col("height") > 0, bytes_to_floats("_data"))).drop("_data")
    if rgb:
        img = img.withColumn("pixels", F.when(F.col("height") > 0, to_rgb(
            "pixels", "height", "width", "n_channels"))).withColumn(
            "n_channels", F.when(F.col("height") > 0, F.lit(3)).otherwise(F.col("n_channels")))
    return img
