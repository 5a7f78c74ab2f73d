"""Spark session defaults and the shared scratch folder.

The engine never decides where a cluster keeps its shared files: it reads
``spark.checkpoint.dir`` from the session.  Only when that is unset (local
runs, tests) does it create a private folder and register it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the engine relies on.  UTC pins the meaning of
# ``now`` and of date truncation; AQE coalesces the many small shuffle
# partitions of chunked aggregates and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "rollwise", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the SQL-level defaults on a session someone else built."""
    for k, v in SESSION_DEFAULTS.items():
        if not k.startswith("spark.sql."):
            continue  # core settings only take effect when the session starts
        try:
            spark.conf.set(k, v)
        except Exception:  # a static SQL conf on a running session
            pass


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach.

    Uses ``spark.checkpoint.dir`` when the cluster names one; otherwise (local
    runs and tests only) makes a private temp folder and registers it as the
    checkpoint dir so ``DataFrame.checkpoint()`` works too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
        if base:
            base = base.rsplit("/", 1)[0] if "/" in base else base
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder: {master} is no local master")
        base = tempfile.mkdtemp(prefix="rollwise-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, *parts) if parts else base


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder (one per run)."""
    return shared_dir(spark, "rollwise", f"{name}-{uuid.uuid4().hex[:12]}")
