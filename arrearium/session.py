"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  Shuffle width is left to AQE: start wide, coalesce
# by measured bytes, split skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on (contract, month) may use rows that already lie by contract.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(app_name: str = "arrearium", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster the setting must exist, because executors on other machines have to
    see the files.  Only a local master, where there is one machine, gets a fresh
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="arrearium-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.

    A long job whose steps are written one after the other then holds those of one step at a time.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
