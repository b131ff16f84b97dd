"""Picture catalogue and integrity manifest from a folder tree.

Files are listed with the ``binaryFile`` source. The catalogue selects only
path, length and modification time, so Spark lists the files without reading
their bytes (``ReadSchema`` holds no ``content``); the manifest reads contents
once to hash them, in parallel across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import PATH_SEP, basename, norm_path
from ..operators.datasets import catalog_from_paths
from ..operators.validate import integrity


def _files(spark: SparkSession, root: str, glob: str | None):
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root)


def image_catalog(spark: SparkSession, root: str, glob: str = "*.jpg",
                  split: str | None = None) -> DataFrame:
    """``(path, file_name, label, split, size_bytes, modified_at)`` for every picture
    under ``root`` (A1). The label is the parent folder; the split is ``split`` when
    given, else the folder above the label (``root/<split>/<label>/<file>``)."""
    files = _files(spark, root, glob).select(
        norm_path("path").alias("path"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"))
    cat = catalog_from_paths(files).withColumn("file_name", basename("path"))
    parts = F.split(F.col("path"), PATH_SEP)
    sp = F.lit(split) if split is not None else F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(-3)))
    return cat.withColumn("split", sp).select("path", "file_name", "label", "split", "size_bytes", "modified_at")


def integrity_manifest(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Size, modification time and SHA-256 of every file under ``root``."""
    files = _files(spark, root, glob).select(norm_path("path").alias("path"), "modificationTime", "content")
    return integrity(files, "content").select(
        "path", "size_bytes", F.col("modificationTime").alias("modified_at"), "sha256")
