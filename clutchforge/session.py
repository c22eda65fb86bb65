"""Spark session settings shared by jobs, tests and the bench.

On a cluster the session already exists (spark-submit); ``configure`` only adds
the SQL settings the jobs rely on. ``local_session`` is for tests and bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. They are SQL confs, so they can be set on a
# running session too.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (measured) size limit for turning a shuffle join into a broadcast.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.caseSensitive": "false",
    # The raw tables have a folder per provider: their writers stay open side by side, so no task sorts its rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # A folder of very many small files is read by so many tasks (tables reach it beyond 64 GB only).
    "spark.sql.files.maxPartitionNum": "4096",
}

# At most so much goes to one task, from files and from a shuffle (smaller settings of the session stay): what a task
# sorts or aggregates fits its memory whatever the size of the tables.
TASK_LIMITS = {
    "spark.sql.files.maxPartitionBytes": 16 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * 1024 * 1024,
}
# Shuffles begin with a partition for so many bytes of (compressed) input files; adaptive execution merges small ones.
INPUT_BYTES_A_PARTITION = 4 * 1024 * 1024
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (the one Python pass,
    ``mapInPandas`` in operators.sequence, runs there): zip it once per
    application and hand it to ``addPyFile``, which distributes it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="clutchforge-pyfiles-"), "clutchforge.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for k, most in TASK_LIMITS.items():
        if as_bytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))
    ship_package(spark)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """As many shuffle partitions as the input needs, the session's number at least."""
    n = -(-input_bytes // INPUT_BYTES_A_PARTITION)
    if n > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FIRST_PARTITIONS, str(n))
    else:
        spark.conf.unset(FIRST_PARTITIONS)


def shuffle_tasks(spark: SparkSession) -> int:
    """The number of partitions a shuffle begins with."""
    return int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clutchforge") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CLUTCHFORGE_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared file system; a session folder
    is made up only where it is unset and everything runs in one process
    (local runs and tests). Elsewhere an unset folder is an error: executors
    would write to their own disks.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clutchforge-ckpt-"))
    return sc.getCheckpointDir()
