"""Session helpers for tests, the bench and local runs.

Library code never builds its own session; it takes the caller's. These helpers only
exist so tests and the bench start Spark the same way.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "16g"))
        # Small inputs: split files at 32 MB so a single mid-sized file still uses all cores.
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("LEDGERLOOM_MAX_PARTITION_BYTES", "32m"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a session of one process (a
    test on a laptop) gets a fresh local folder; a cluster session is refused, as its
    executors could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared directory for one run's files."""
    return f"{shared_dir(spark)}/ledgerloom-{name}-{uuid.uuid4().hex[:12]}"
