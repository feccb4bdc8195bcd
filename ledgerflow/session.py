"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from typing import Optional

from pyspark.sql import SparkSession

# Settings that change results or plan shape; applied by ``configure``.
RECOMMENDED = {
    # Timestamps compare and print in UTC, like the test oracle.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions (left side of left-semi/anti joins included), turn
    # shuffled joins into broadcast joins when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RECOMMENDED.items():
        spark.conf.set(k, v)
    return spark


def size_shuffle_partitions(spark: SparkSession, input_bytes: int,
                            target_bytes: int = 256 * 1024 * 1024) -> int:
    """Set ``spark.sql.shuffle.partitions`` so a shuffle of ``input_bytes``
    lands in partitions of about ``target_bytes``; a count that is set higher
    already stays.

    AQE coalesces small partitions downwards at runtime, but it cannot split
    a partition that is too large to sort or hash in memory, so the starting
    count is sized for the largest shuffle of the job.  Returns the count.
    """
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(input_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, 256 << 20)))
    return n


def local_session(cores: Optional[int] = None, shuffle_partitions: Optional[int] = None,
                  app: str = "ledgerflow") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no ports beyond
    Spark's own)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "4g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores)))
    for k, v in RECOMMENDED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SCRATCH: dict[str, str] = {}


def configured_base(spark: SparkSession) -> Optional[str]:
    """The folder that ``spark.checkpoint.dir`` names, as configured (never
    the per-application folder that Spark makes below it), or ``None``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return base.rstrip("/") if base else None


def durable_base(spark: SparkSession) -> str:
    """``configured_base``, for state that must outlive the application (stream
    bookmarks); raises if none is configured."""
    base = configured_base(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a durable folder, or pass an explicit checkpoint")
    return base


def shared_base(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    On a cluster the setting points at shared storage and is only read here;
    if it is unset there, this raises rather than fall back to a folder local
    to one machine.  Only a local-mode session (tests) gets one scratch folder
    per application when the setting is unset.
    """
    base = configured_base(spark)
    if base:
        return base
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if sc.applicationId not in _SCRATCH:
        _SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    return _SCRATCH[sc.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set Spark's checkpoint folder once per application; returns it.  (Spark
    appends an id of its own, so the folder it reports is never set again.)"""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_base(spark))
    return sc.getCheckpointDir()
