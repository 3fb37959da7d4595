"""SparkSession helper with the settings the feature job relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package expects.  AQE re-plans joins from
# measured sizes (that is our only broadcast decision for data-sized frames)
# and splits skewed join partitions even where that adds a shuffle for the
# aggregation that follows (a hot entity then costs a small extra exchange
# of partial aggregates instead of one straggler task).  A table's size before
# a run is its file size, of narrow sorted columns a tenth of the rows' size in
# memory: the factor keeps such frames from being broadcast through the driver.
# Scans are cut small, so that the sort before a partial aggregate of texts
# stays in memory.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "10",
    "spark.sql.files.maxPartitionBytes": "32m",
}


def recommended_conf(input_bytes: int, executor_cores: int = 4, executors: int = 1000) -> dict[str, str]:
    """Shuffle sizing for a cluster run: about 256 MB per shuffle partition of
    the largest shuffle (the history, close to the input size), never fewer
    partitions than cores; AQE coalesces small ones and splits skewed ones."""
    cores = executor_cores * executors
    parts = max(cores * 2, int(input_bytes // (256 * 1024 * 1024)) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply JOB_CONF to an existing session (runtime SQL confs only)."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside this block a query's shuffle files go when it ends, not when the driver happens to collect its
    garbage: disk then holds those of one stage.  For results that are stored and read back."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect has no SparkContext
        return spark.conf.get("spark.app.id", "connect")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that all executors share and is used
    as given; without it (and without a folder set on the context) the run stops here:
    a machine-local folder would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's setting is authoritative
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return d
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def get_spark(master: str | None = None, partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and bench, with a checkpoint folder of its own; on a cluster use the given session."""
    master = master or os.environ.get("HISTLENS_MASTER", "local[8]")
    b = (
        SparkSession.builder.master(master)
        .appName("histlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("HISTLENS_DRIVER_MEM", "16g"))
        .config("spark.sql.shuffle.partitions", str(partitions or 8))
    )
    for k, v in {**JOB_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histlens-ckpt-"))
    return spark
