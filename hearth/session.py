"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local run needs; a cluster session keeps its own values.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "hearth") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("HEARTH_DRIVER_MEMORY", "16g"))
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (distributed) folder and is used
    as is. When it is unset, the context's checkpoint folder is used if one
    was set. A local run (tests) then gets a fresh local folder for the
    context; on a cluster a machine-local folder would break later reads, so
    an unset folder raises RuntimeError.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    d = tempfile.mkdtemp(prefix="hearth-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def recommended_conf(input_bytes: int, target_partition_bytes: int = 200 << 20) -> dict[str, str]:
    """Settings sized to the input for a cluster run (apply with
    ``SparkSession.builder.config(k, v)`` or ``spark.conf.set``).

    * one shuffle partition per ~200 MB of input, at least 200 (AQE coalesces
      small ones and splits skewed ones at run time);
    * 256 MB file splits;
    * AQE on, with skew-join splitting, and a 256 MB advisory partition size.

    ``spark.checkpoint.dir`` is not set here: it must name the cluster's
    shared folder and comes from the cluster's own configuration.
    """
    partitions = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }
