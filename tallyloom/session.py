"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that hold at any data size. Nothing here is sized to a machine:
# AQE picks post-shuffle partition counts and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build or reuse a session; keyword arguments use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``. Only a local session may do without and takes its warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tallyloom-scratch"
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path of this application below the shared folder."""
    return "/".join([shared_dir(spark), "tallyloom", spark.sparkContext.applicationId, *parts])


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once as Parquet below the shared folder and read back."""
    path = scratch_path(frame.sparkSession, name, uuid.uuid4().hex)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
