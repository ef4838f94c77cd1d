"""Session settings the package relies on."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import SparkSession

# Settings every job needs for right results or for skew handling. On a cluster
# they belong in spark-defaults; shuffle.partitions is left to the cluster as the least
# number, ``deal_by_size`` raises it with the input and adaptive execution coalesces it.
# A task holds many times the compressed bytes it reads, hence the small partitions, of
# shuffles and of scans: sorts and sums before a shuffle hold what their scan task reads.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Optional: without this, every Column call walks the Python stack for error messages,
# which costs more than planning for plans of this size.
PLAN_FASTER = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "mercato", cores: int | None = None, **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use ``apply_settings``."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MERCATO_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**REQUIRED, **PLAN_FASTER, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings on a session somebody else created."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Bytes of input files to a shuffle partition.
_INPUT_BYTES = 4 << 20


def deal_by_size(spark: SparkSession, paths: Iterable[str]) -> int:
    """Let shuffles have a partition for every few MB of the files under ``paths``; returns their number.

    With a fixed number a task's sorts and joins would grow with the tables. Adaptive
    execution joins only what is left small (below 1 MB): were partitions joined up to the
    advisory size, a task would hold more of a large shuffle than of a small one.
    """
    size = 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(at):
            size += files.getContentSummary(at).getLength()
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // _INPUT_BYTES))
    for setting in ("initialPartitionNum", "minPartitionNum"):
        spark.conf.set(f"spark.sql.adaptive.coalescePartitions.{setting}", str(number))
    return number
