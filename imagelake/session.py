"""Session settings shared by jobs, tests and the bench.

On a cluster the session comes from the launcher; ``tune`` only fills in what
is unset. ``checkpoint_dir`` reads ``spark.checkpoint.dir``; only a local-mode
session (tests) without one gets a scratch folder, a cluster without one is an
error.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on for correct results: UTC timestamps, ANSI casts.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Settings for scale (adaptive execution re-plans joins and splits skewed
# partitions at runtime; Arrow moves batches to Python). A cluster's own values
# win: ``tune`` sets these only where the session has none.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
SQL_DEFAULTS = {**REQUIRED, **PREFERRED}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "imagelake", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply REQUIRED always and PREFERRED where the session has no explicit value,
    and make sure Python workers can import this package."""
    for k, v in REQUIRED.items():
        spark.conf.set(k, v)
    explicit = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for k, v in PREFERRED.items():
        if k not in explicit:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers once per application
    (what ``spark-submit --py-files`` does), so Arrow-batched functions that
    run there can import it whatever the driver's working directory is."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext here (e.g. a remote session)
        return
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="imagelake-pkg-"), "imagelake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("imagelake", os.path.relpath(full, pkg)))
    try:
        sc.addPyFile(out)
    except Exception:  # noqa: BLE001 - workers then need the package installed
        return
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a scratch folder only when unset."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if not sc.master.startswith("local"):
        # a machine-local folder would scatter checkpoint files over executors
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares")
    d = tempfile.mkdtemp(prefix="imagelake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One TESTDATA table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Target bytes per task for scans and (after AQE coalescing) shuffles: large
# enough to amortise task overhead, small enough to sort/aggregate in executor
# memory without heavy spilling.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 65536


def partition_plan(input_bytes: int, total_cores: int,
                   target: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Partition settings for a job reading ``input_bytes`` on ``total_cores``:
    scan splits of ``target`` bytes, an initial shuffle width of one partition per
    ``target`` bytes (at least two waves of tasks, at most 65,536) that adaptive
    execution then coalesces towards ``target``."""
    width = max(2 * total_cores, -(-int(input_bytes) // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(min(width, MAX_SHUFFLE_PARTITIONS)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
    }


def size_for(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Apply ``partition_plan`` for this cluster where the session has no explicit
    value; returns the settings in force."""
    sc = spark.sparkContext
    plan = partition_plan(input_bytes, sc.defaultParallelism)
    explicit = {k for k, _ in sc.getConf().getAll()}
    for k, v in plan.items():
        if k not in explicit:
            spark.conf.set(k, v)
    return {k: spark.conf.get(k) for k in plan}
