"""Session helpers: a local session for tests and the bench, and the shared
folder used for checkpoints and published tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "equilibra") -> SparkSession:
    """A local session with AQE on and the UI off (tests and bench only)."""
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
        .config("spark.driver.memory", os.environ.get("EQUILIBRA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster this setting names storage every executor can reach; it is
    read, never replaced, and required: without it this raises. Only in a
    ``local`` session, where driver and executors are one process on one machine,
    is a folder of our own created and registered.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="equilibra-")
        spark.conf.set(CHECKPOINT_CONF, path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")
