"""Session helpers: a local session for tests/bench and shared scratch paths.

Everything that writes an intermediate table (materialised layouts, merge
targets, landed months) goes under the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared by all executors, so a lost
executor never takes a written table with it. Only when the setting is
absent (unit tests, local runs) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def session_conf(task_slots: int, shuffle_partitions: int) -> dict[str, str]:
    """The settings the jobs are written for; on a cluster put the same keys in spark-defaults.

    ``task_slots`` is the number of executor cores. Partition discovery of a
    table with thousands of day folders otherwise launches one listing task
    per folder; a bound of a few waves over the cores lists the same folders
    with far fewer tasks. A small coalescing floor keeps a modest batch that
    feeds a day-partitioned write spread over the cores: every writer task
    opens one file per day it holds, and that per-file cost, not the bytes,
    dominates such writes.
    """
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(max(2 * task_slots, 8)),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ridemart") -> SparkSession:
    """Session for tests and the local bench: UTC, AQE on, UI off."""
    slots = (os.cpu_count() or 8) if cores == "*" else int(cores)
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "10g")
    )
    for k, v in session_conf(slots, shuffle_partitions).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def pin_time_zone(spark: SparkSession, default: str = "UTC") -> str:
    """Keep the time zone named at submit time; otherwise use ``default``.

    Row ids hash the timestamp text and the merge prunes by pickup day, so all
    loads into one target must format timestamps in the same zone. A session
    whose zone was left to the machine's clock setting gets ``default``.
    """
    key = "spark.sql.session.timeZone"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, default)
    return spark.conf.get(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a local master without the setting gets a temporary one."""
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ridemart-ckpt-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ridemart/{name}-{uuid.uuid4().hex[:12]}"


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme so Python can inspect a local path (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
