"""SparkSession helpers.

Library code never creates a session; it takes the caller's.  ``local_session`` is for
tests and the benchmark only.  ``checkpoint_dir`` honours the cluster's shared
``spark.checkpoint.dir`` and only falls back to a scratch directory when none is configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fulcrum") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("FULCRUM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a scratch folder (tests, benchmark); on a
    cluster a machine-local folder would be invisible to the executors, so it is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors (staged tables live there)")
    scratch = tempfile.mkdtemp(prefix="fulcrum-ckpt-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of Parquet.

    * ``spark.sql.files.maxPartitionBytes``: scan splits of ~``target_partition_bytes``.
    * ``spark.sql.shuffle.partitions``: the widest shuffle (the item roll-up) moves about as
      much as it reads, so one partition per ``target_partition_bytes`` of input, rounded up
      to whole waves of the cluster's task slots; AQE coalesces small ones and splits skewed
      ones at run time.
    * AQE with skew-join handling on; broadcast threshold left at Spark's checked default.
    """
    slots = max(1, executors * cores_per_executor)
    wanted = max(1, -(-input_bytes // target_partition_bytes))
    partitions = -(-wanted // slots) * slots
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
    }
