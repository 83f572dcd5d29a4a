"""SparkSession helpers for tests, bench and local runs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "visitflow") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VISITFLOW_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private temp folder only in
    local mode, where the driver and the executors are one process."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="visitflow-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for intermediate outputs."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
