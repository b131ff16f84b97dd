"""Labels, prices and display records.

Dimensions are bounded by the class count (15 rows), so every lookup here is a
broadcast hash join: no shuffle of the fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import PRICE_DEFAULTS
from ..functions.names import basename, capitalize


def decode_label(df: DataFrame, classes: DataFrame, id_col: str = "class_id",
                 out_col: str = "fruit") -> DataFrame:
    """Class id -> class name."""
    dim = F.broadcast(classes.select(F.col("class_id").alias("_cid"), F.col("name").alias(out_col)))
    return df.join(dim, df[id_col] == dim["_cid"], "left").drop("_cid")


def price_lookup(df: DataFrame, prices: DataFrame, catalog: str = "app",
                 name_col: str = "fruit", default: str | None = None) -> DataFrame:
    """Case-insensitive name -> price of one catalogue, default text when absent (F1).
    Adds ``price_text`` (STRING) and ``price`` (DECIMAL(6,2), null when absent)."""
    default = PRICE_DEFAULTS.get(catalog, "N/A") if default is None else default
    dim = F.broadcast(prices.where(F.col("catalog") == catalog).select(
        F.lower("name").alias("_pname"), F.col("price_text").alias("_ptext"),
        F.col("price").alias("_price")))
    j = df.join(dim, F.lower(df[name_col]) == dim["_pname"], "left")
    return (j.withColumn("price_text", F.coalesce(F.col("_ptext"), F.lit(default)))
             .withColumn("price", F.col("_price"))
             .drop("_pname", "_ptext", "_price"))


def result_record(df: DataFrame, path_col: str = "image_url") -> DataFrame:
    """The reference's result record (F3):
    ``image_path, filename, prediction, confidence, price``."""
    return df.select(
        F.col(path_col).alias("image_path"),
        F.coalesce(F.col("filename"), basename(path_col)).alias("filename"),
        capitalize("fruit").alias("prediction"),
        F.col("confidence"),
        F.col("price_text").alias("price"))


def percent_2(c) -> F.Column:
    """``0.97125 -> '97.13%'``: rounded to whole basis points, then formatted with
    integer arithmetic so every engine prints the same text."""
    bp = F.round(F.col(c) * 10000).cast("long") if isinstance(c, str) else F.round(c * 10000).cast("long")
    return F.concat((bp / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((bp % 100).cast("string"), 2, "0"), F.lit("%"))


def results_table(df: DataFrame) -> DataFrame:
    """Display rows (F4): image, fruit (as stored in the log), confidence as a
    percentage, price, time."""
    return df.select(
        F.col("filename").alias("image"),
        F.col("fruit"),
        percent_2("confidence").alias("confidence"),
        F.col("price_text").alias("price"),
        F.date_format("processed_at", "HH:mm:ss").alias("processed"))


# fixed values: status thresholds of the camera views.
DETECTED_ABOVE = 0.7
POSSIBLE_ABOVE = 0.5


def detection_status(df: DataFrame, hi: float = DETECTED_ABOVE, lo: float = POSSIBLE_ABOVE,
                     mask: bool = False, conf_col: str = "confidence") -> DataFrame:
    """``detected`` above ``hi``, ``possible`` above ``lo``, else ``uncertain``.
    With ``mask``, uncertain rows hide the name and the price."""
    c = F.col(conf_col)
    status = F.when(c > hi, "detected").when(c > lo, "possible").otherwise("uncertain")
    out = df.withColumn("status", status)
    if mask:
        hide = F.col("status") == "uncertain"
        for name in ("fruit", "price_text"):
            if name in df.columns:
                out = out.withColumn(name, F.when(~hide, F.col(name)))
    return out
