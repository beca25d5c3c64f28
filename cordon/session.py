"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cordon") -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own builder config."""
    builder = (
        SparkSession.builder.config(map=_work_folder()).master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no Python call-site capture per Column call: fewer JVM round trips when building plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CORDON_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_work_dir(spark)
    return spark


def _work_folder() -> dict[str, str]:
    """The setting for a fresh work folder on this machine, where neither a running session nor Spark's defaults name one."""
    from pyspark import SparkConf, SparkContext

    if SparkContext._active_spark_context is not None or SparkConf().get(CHECKPOINT_KEY, None):
        return {}
    return {CHECKPOINT_KEY: tempfile.mkdtemp(prefix="cordon-ckpt-")}


#: work folders of local sessions that were started without one, by application
_LOCAL_FOLDERS: dict[str, str] = {}


def ensure_work_dir(spark: SparkSession) -> str:
    """Return the cluster's shared folder (``spark.checkpoint.dir``).

    Only on a local master is a fresh scratch folder set where the session has none; on a
    cluster, a folder of the driver's machine would be another one on each executor.
    """
    current = work_dir(spark)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master or ""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"{CHECKPOINT_KEY} is not set: a cluster ({master}) needs a folder that all its executors share")
    path = tempfile.mkdtemp(prefix="cordon-ckpt-")
    _LOCAL_FOLDERS[spark.sparkContext.applicationId] = path  # Spark takes the setting at its start only
    spark.sparkContext.setCheckpointDir(path)
    return path


def work_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(CHECKPOINT_KEY, None)
    if not value:
        value = spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    return value or _LOCAL_FOLDERS.get(getattr(spark.sparkContext, "applicationId", ""))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique location under the shared folder for a materialised table."""
    base = work_dir(spark) or ensure_work_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# Runtime SQL settings the audit is designed around (all settable on a live session).
# Only scans and written tables carry volume; every shuffle is post-aggregation, so the
# partition-size settings matter for scans and the table write, AQE for the rest.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}
# static (set when the session is built): no Python call-site capture per Column call
BUILD_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def apply_cluster_conf(spark: SparkSession, overwrite: bool = False) -> dict[str, str]:
    """Set :data:`CLUSTER_CONF` on a session, keeping values the cluster already chose
    unless ``overwrite``.  Returns what was set."""
    applied = {}
    for key, value in CLUSTER_CONF.items():
        if not overwrite and spark.conf.isModifiable(key) and _explicitly_set(spark, key):
            continue
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def _explicitly_set(spark: SparkSession, key: str) -> bool:
    return spark.sparkContext.getConf().contains(key)
