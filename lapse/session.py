"""Spark session helpers.

Cluster jobs pass their own session; ``local_session`` is for tests and the bench.  The
checkpoint directory is read from ``spark.checkpoint.dir`` and only set to a fresh scratch
folder when the session has none (local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def recommended_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Cluster settings sized from the total input: about one initial shuffle partition per
    ``target_partition_bytes`` of input (AQE coalesces small ones and splits skewed ones),
    scan splits of the same size, and skew-join thresholds relative to it.

    At 100 TB and 256 MB this gives ~400k initial partitions, capped at 200k; a key holding
    a third of the rows then lands in partitions that AQE's skew join splits further.
    """
    parts = max(200, min(200_000, input_bytes // target_partition_bytes))
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lapse") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LAPSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Order: the SparkContext's checkpoint folder, else the ``spark.checkpoint.dir`` setting (read
    only: it cannot be changed on a running session), else - only with a local master, whose
    executors all live on this machine - a fresh scratch folder.  Any other master without the
    setting is refused: executors would each write to a disk of their own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions expose no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="lapse-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def is_local(master: str) -> bool:
    """Whether driver and executors are one process ("local-cluster" is a cluster)."""
    return master == "local" or master.startswith("local[")
