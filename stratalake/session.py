"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None


def get_spark(app: str = "stratalake", cores: int | None = None) -> SparkSession:
    """Session for tests, the bench and small machines; a cluster brings its own settings."""
    cores = cores or os.cpu_count() or 1
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` or the context's checkpoint folder.

    Only a local session may fall back to a temporary folder of the machine.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="stratalake-")
    return _local_root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused table or checkpoint path below the shared folder."""
    return f"{scratch_root(spark)}/stratalake/{label}-{uuid.uuid4().hex[:12]}"
