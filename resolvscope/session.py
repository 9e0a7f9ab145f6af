"""Session settings the jobs are written for."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Report time is formatted and truncated in the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Shuffle sizes, join strategy and skewed partitions are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets ``row_number() <= k`` cut each map task to k rows per group before the shuffle, for the lists used here.
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
    # A replayed interval replaces its own partitions only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, or a fresh local one in tests."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="resolvscope-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def work_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
