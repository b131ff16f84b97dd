"""Compaction of a micro-batch log (B3, A7): many small batch folders become a few files.

The scoring stream writes ``<target>/batch_id=<n>``. ``compact_log`` rewrites the batches
that the newest manifest does not cover into one new folder under ``<target>/_compacted``
(sorted by session, so a session lookup skips most row groups) and then writes the
manifest of the next version, which names all compacted folders and the highest batch
they hold. A manifest appears in one rename, so a reader sees the log before or after
it, and each row once either way: ``read_log`` reads the folders of the newest manifest
and the batches above its highest one. Folders beginning with ``_`` are hidden from
plain readers. A run that fails leaves a folder that no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS, COMPACTED = "_manifests", "_compacted"


def _paths(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def newest_manifest(spark: SparkSession, target: str) -> dict:
    """``version``, ``folders`` and ``upto`` (highest compacted batch); version 0 without any."""
    fs, folder = _paths(spark, f"{target}/{MANIFESTS}")
    versions = [int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()] if fs.exists(folder) else []
    if not versions:
        return {"version": 0, "folders": [], "upto": -1}
    text = spark.read.text(f"{target}/{MANIFESTS}/{max(versions)}", wholetext=True).first()["value"]
    return json.loads(text)


def _write_manifest(spark: SparkSession, target: str, manifest: dict) -> None:
    """Write the manifest beside its place, then rename it there: only one writer gets a version."""
    fs, place = _paths(spark, f"{target}/{MANIFESTS}/{manifest['version']}")
    _, draft = _paths(spark, f"{target}/{MANIFESTS}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise RuntimeError(f"manifest {manifest['version']} of {target} was written by another compaction")


def _batches(spark: SparkSession, target: str, above: int) -> list[int]:
    fs, root = _paths(spark, target)
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    return sorted(b for b in (int(n[9:]) for n in names if n.startswith("batch_id=") and n[9:].isdigit()) if b > above)


def read_log(spark: SparkSession, target: str) -> DataFrame:
    """The log as it stands, with ``batch_id``: compacted folders and the batches after them."""
    manifest = newest_manifest(spark, target)
    parts = [spark.read.parquet(*[f"{target}/{COMPACTED}/{f}" for f in manifest["folders"]])] if manifest["folders"] else []
    later = _batches(spark, target, manifest["upto"])
    if later or not parts:
        log = spark.read.parquet(target)  # partition pruning leaves the batches already compacted unread
        parts.append(log.where(F.col("batch_id") > manifest["upto"]).withColumn("batch_id", F.col("batch_id").cast("long")))
    first = parts[0].withColumn("batch_id", F.col("batch_id").cast("long"))
    return first.unionByName(parts[1]) if len(parts) > 1 else first


def compact_log(spark: SparkSession, target: str, keep_newest: int = 1, file_rows: int = 1_000_000) -> dict:
    """Compact all batches but the ``keep_newest`` (a running stream may still replay its
    last one); returns the manifest in force. Old batch folders stay for running readers."""
    manifest = newest_manifest(spark, target)
    batches = _batches(spark, target, manifest["upto"])
    batches = batches[:len(batches) - keep_newest] if keep_newest else batches
    if not batches:
        return manifest
    lo, hi = batches[0], batches[-1]
    rows = spark.read.parquet(target).where(F.col("batch_id").between(lo, hi)).withColumn("batch_id", F.col("batch_id").cast("long"))
    folder = f"{lo}-{hi}-{uuid.uuid4().hex}"
    files = max(1, -(-rows.count() // file_rows))
    (rows.repartitionByRange(files, "session_id", "processed_at").sortWithinPartitions("session_id", "processed_at")
         .write.parquet(f"{target}/{COMPACTED}/{folder}"))
    new = {"version": manifest["version"] + 1, "folders": [*manifest["folders"], folder], "upto": hi}
    _write_manifest(spark, target, new)
    return new
