"""Session construction and the shared scratch location.

Cluster jobs get their settings from ``spark-submit``; :func:`local_session`
exists for tests and the bench. Scratch data (lineage cuts, published tables
written by checks) always goes below ``spark.checkpoint.dir``, the shared
folder the cluster names. A default is set only when the session has none,
which is the case in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "reelrank") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach")
        # Local mode only (tests): the driver is the only machine.
        configured = tempfile.mkdtemp(prefix="reelrank-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one output."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "reelrank", f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def sized_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan settings sized by the input, for a cluster run.

    Shuffle partitions are set so that one partition of the largest shuffle
    (about the input size, the ratings de-duplication) is near
    ``target_partition_bytes``, and never fewer than two waves of the cores;
    AQE then merges small partitions and splits skewed ones at run time.
    For 100 TB of input and 256 MB partitions this gives ~400,000 partitions.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
