"""Session settings for tests and benchmarks, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, name: str = "pulsegrid") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per column
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master without that setting,
    where driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/pulsegrid/{name}-{uuid.uuid4().hex}"
