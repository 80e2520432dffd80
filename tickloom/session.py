"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Every boundary is a UTC boundary.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # INT64 times carry min/max statistics, so time filters skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A rewritten day replaces that day only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session with the library's settings, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tickloom")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    _share_code(session)
    return session


def apply_settings(spark: SparkSession) -> None:
    """Set the library's settings on a session made elsewhere."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    _share_code(spark)


def _share_code(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver does, in case it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables.

    On a cluster it lies below ``spark.checkpoint.dir``, which all executors
    share. A machine-local folder is used only with a local master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tickloom/{name}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"tickloom-{name}-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
