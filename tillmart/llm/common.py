"""Shared folders and written intermediate tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.sources.scratch import scratch_dir


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that all executors reach, gone when the session's driver ends."""
    return scratch_dir(spark, label) + "/rows"


# Folders of the tables that the innermost `passing_tables` will remove.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def written(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """The rows of `df`, written once to the shared folder and read from there.

    It cuts the lineage at files that outlive any executor. Within `passing_tables` the files
    go at its end, unless they are to be kept.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, label)
    df.write.parquet(folder)
    passing = _passing.get()
    if passing is not None and not keep:
        passing.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


# Spark's setting to remove the shuffle files of a query when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Remove tables written inside at the end, when what was made of them is written too.

    Inside, shuffle files go as soon as the table or count that they were made for is there.
    """
    folders: list[str] = []
    outer = _passing.set(folders)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
        _passing.reset(outer)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups of a key by which the rows are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        before = held[0].column(held[0].schema.get_field_index(key))[0].as_py()
        if len(changes):
            start = int(changes[-1]) + 1
        elif before != keys[0]:
            start = 0
        else:
            continue
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, start)])
        held = [batch.slice(start)]
    if held:
        yield pa.Table.from_batches(held)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that few texts are Python strings at once."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A column of numbers without nulls."""
    return column.combine_chunks().to_numpy(zero_copy_only=False)


def raw_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each value begins, with the end."""
    values = [value for value in column.to_pylist()]
    first = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(value) for value in values], out=first[1:])
    return np.frombuffer(b"".join(values), np.uint8), first


def most_frequent(counts: DataFrame, column: str, limit: int) -> DataFrame:
    """The rows with the largest counts, at most `limit` of them.

    Counts are binned by their logarithm and whole bins are taken from the top, so nothing is
    sorted and only the bins, some two thousand at most, come to the driver.
    """
    place = F.floor(F.log2(column) * 32).cast("int")
    bins = counts.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("rows")).collect()
    lowest, taken = None, 0
    for row in sorted(bins, key=lambda row: -row["place"]):
        taken += row["rows"]
        if taken > limit:
            break
        lowest = row["place"]
    return counts.limit(0) if lowest is None else counts.filter(place >= lowest)


def most_frequent_by(counts: DataFrame, key: str, column: str, limit: int) -> DataFrame:
    """The rows with the largest counts of each key, at most `limit` of them in all.

    Each key has the same share of the limit, so a rare key keeps its own. As in
    `most_frequent`, whole bins are taken from the top, and only bins come to the driver.
    """
    place = F.floor(F.log2(column) * 32).cast("int")
    bins = counts.groupBy(F.col(key).alias("key"), place.alias("place"))
    held: dict[str, dict[int, int]] = {}
    for row in bins.agg(F.count(F.lit(1)).alias("rows")).collect():
        held.setdefault(row["key"], {})[row["place"]] = row["rows"]
    lowest: list[tuple[str, int]] = []
    for name, rows in held.items():
        taken, least = 0, None
        for at in sorted(rows, reverse=True):
            taken += rows[at]
            if taken > limit // len(held):
                break
            least = at
        if least is not None:
            lowest.append((name, least))
    spark = counts.sparkSession
    bounds = spark.createDataFrame(lowest, "_key string, _lowest int")
    met = counts.join(bounds, F.col(key) == F.col("_key"))
    return met.filter(place >= F.col("_lowest")).drop("_key", "_lowest")
