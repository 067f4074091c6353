"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Timestamps on the wire are UTC and `date` is derived in the session zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Window state per meter may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "meterlake", **settings: str) -> SparkSession:
    """Session with the library's settings; cores and memory stay with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table, under the cluster's shared folder.

    The folder is `spark.checkpoint.dir`. A temporary folder is used only in local mode,
    where driver and executors share one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_scratch()
    return f"{base.rstrip('/')}/meterlake/{label}-{uuid.uuid4().hex}"


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """Removed when Python ends."""
    return tempfile.TemporaryDirectory(prefix="meterlake-", ignore_cleanup_errors=True)


def _local_scratch() -> str:
    return _local_folder().name
