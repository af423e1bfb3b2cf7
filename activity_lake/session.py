"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

from activity_lake.sinks.hadoop import HadoopFiles

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Opt-in for stores whose rename is not atomic, passed to build_session(extra=...).
OBJECT_STORE_CHECKPOINTS = {
    "spark.sql.streaming.checkpointFileManagerClass":
        "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
}


def build_session(app: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder; nothing is created yet, and what is there when the session's process ends is removed."""
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    atexit.register(_remove, HadoopFiles(spark, path), path)
    return path


def _remove(files: HadoopFiles, path: str) -> None:
    try:
        files.delete(path)
    except Exception:  # the JVM may be gone already; then the folder's owner cleans up
        pass


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping the folder the cluster named."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
