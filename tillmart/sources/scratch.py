"""Folders for intermediate tables that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHARED_DIR_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A new folder name under `base`, which goes when the session's driver ends.

    Without `base` it is the shared folder the session names, else a folder beside the
    tables of its warehouse, unless that is on a disk of the driver alone.
    """
    base = base or spark.conf.get(SHARED_DIR_SETTING, None) or _beside_tables(spark)
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


@contextmanager
def passing_dir(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder as `scratch_dir` gives, which goes at the end of the block."""
    folder = scratch_dir(spark, label)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Spark's setting to remove the shuffle files of a query when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go as soon as the table or count that they were made for is there."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _beside_tables(spark: SparkSession) -> str:
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    require_shared(spark.sparkContext.master, scheme)
    return f"{warehouse}/_scratch"


def require_shared(master: str, scheme: str) -> None:
    """A cluster's executors do not see the driver's own disk."""
    if scheme == "file" and not master.startswith("local"):
        raise ValueError(
            f"{SHARED_DIR_SETTING} names no shared folder, and the warehouse is on the driver's disk"
        )
