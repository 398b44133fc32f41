"""Session helpers: a local session for tests and the shared folder for staging."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench. Clusters pass their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallylog")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYLOG_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for staged tables: what ``spark.checkpoint.dir`` names.

    A local session that names none (tests) gets a folder of its own under the
    local temp folder, which all of its tasks see. A cluster session that names
    none is refused, as its executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not configured and context is not None:
        configured = context.getCheckpointDir()
    if not configured:
        if context is None or not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tallylog-ckpt-")
    if context is not None and not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/tallylog/{name}-{uuid.uuid4().hex}"
