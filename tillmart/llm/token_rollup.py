"""Token counts in rollups that are kept up to date by signed changes.

A batch of changes holds signed rows: +1 for a document that comes in, -1 for one that goes
out, and both for one whose count is revised, the old row taken back and the new one added.
Summed by source, language and tokenizer version they are added to the totals, so a batch
costs what it holds and never reads the documents again.

The totals live in a folder of the shared store with one sub-folder per batch. A batch is
written under its own name and counts from the moment Spark's success marker is there;
committing it again does nothing, and a batch that broke off is written anew. Batches may be
merged into a snapshot, which remembers their names.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import slices
from tillmart.llm.packing import word_ids

KEYS = ["source", "lang", "tokenizer"]
COUNTS = "doc_id long, source string, lang string, tokenizer string, tokens long, chars long"
SNAPSHOTS = "_snapshots"
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long, chars long"


# --- counts of documents ----------------------------------------------------------


def _count_task(
    batches: Iterable[pa.RecordBatch], path: str, version: str
) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [text or "" for text in batch.column(3).to_pylist()]
        tokens = [len(ids) for ids in word_ids(path).ids(texts)]
        chars = [len(text) for text in texts]
        added = [pa.array([version] * len(texts)), pa.array(tokens), pa.array(chars)]
        names = [*batch.schema.names[:3], "tokenizer", "tokens", "chars"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *added], names)


def token_counts(
    documents: DataFrame, path: str, version: str, text_col: str = "text"
) -> DataFrame:
    """doc_id, source, lang, tokenizer, tokens and chars of every whole text.

    A null text has no tokens; null ids, sources and languages stay null. A repeated row is
    counted again. Other columns are not read; an empty table gives no rows.
    """
    chosen = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    return chosen.mapInArrow(functools.partial(_count_task, path=path, version=version), COUNTS)


# --- signed changes ----------------------------------------------------------------


def inserted(counts: DataFrame) -> DataFrame:
    """Changes that add documents, as `token_counts` counts them: null keys are keys, and null
    numbers add nothing."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("docs"), "tokens", "chars")


def deleted(counts: DataFrame) -> DataFrame:
    """Changes that take documents back, from the counts they were added with."""
    return counts.select(
        *KEYS, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"),
        (-F.col("chars")).alias("chars"),
    )


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changes from old counts of some documents to new ones, perhaps under other keys."""
    return deleted(before).unionByName(inserted(after))


class TokenRollup:
    """Totals by source, language and tokenizer version in a folder of committed batches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _written(self, *parts: str) -> list[str]:
        """Names under a folder whose write has ended, in order."""
        fs = self._fs()
        if not fs.exists(self._path(*parts)):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(self._path(*parts))]
        return sorted(n for n in names if fs.exists(self._path(*parts, n, "_SUCCESS")))

    def _snapshot(self) -> str | None:
        """The folder of the last snapshot."""
        snapshots = self._written(SNAPSHOTS)
        return f"{self.folder}/{SNAPSHOTS}/{snapshots[-1]}" if snapshots else None

    def _merged(self, snapshot: str | None) -> DataFrame:
        """Names of the batches that a snapshot holds."""
        if snapshot is None:
            return self.spark.createDataFrame([], "value string")
        return self.spark.read.text(f"{snapshot}/names").select("value")

    def _unmerged(self, snapshot: str | None) -> list[str]:
        """Batches beside the snapshot; of merged names only those whose folders are still there
        are asked for."""
        written = self._written()
        if snapshot is None or not written:
            return written
        held = self._merged(snapshot).filter(F.col("value").isin(written)).collect()
        return sorted(set(written) - {row.value for row in held})

    def _holds(self, batch: str) -> bool:
        """Whether a batch was committed, told by its own name alone."""
        if self._fs().exists(self._path(batch, "_SUCCESS")):
            return True
        return not self._merged(self._snapshot()).filter(F.col("value") == batch).isEmpty()

    def batches(self) -> list[str]:
        """Names of all batches ever committed, in order; for looking at, not for commits."""
        merged = self._merged(self._snapshot()).collect()
        return sorted({*self._written(), *(row.value for row in merged)})

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes once; false if it was there already."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9-]*", batch):
            raise ValueError(f"a batch needs a name of letters, digits and dashes, not {batch!r}")
        if self._holds(batch):
            return False
        _summed(changes).write.mode("overwrite").parquet(f"{self.folder}/{batch}")
        return True

    def merge(self) -> None:
        """Sum the batches so far into one snapshot, which totals start from afterwards.

        A snapshot counts once its success marker is there, after both its parts are. Folders of
        batches that the snapshot before held already are removed, so that readers which have
        begun can end and few folders stay.
        """
        snapshot = self._snapshot()
        fresh = self._unmerged(snapshot)
        gone = sorted(set(self._written()) - set(fresh))
        number = f"{len(self._written(SNAPSHOTS)):08d}"
        path = f"{self.folder}/{SNAPSHOTS}/{number}"
        self.totals().write.mode("overwrite").parquet(f"{path}/totals")
        listed = self.spark.createDataFrame([(name,) for name in fresh], "value string")
        listed.unionByName(self._merged(snapshot)).write.mode("overwrite").text(f"{path}/names")
        self._fs().create(self._path(SNAPSHOTS, number, "_SUCCESS")).close()
        for name in gone:
            self._fs().delete(self._path(name), True)

    def totals(self) -> DataFrame:
        """Totals of all committed batches; keys whose documents are all gone are left out."""
        snapshot = self._snapshot()
        paths = [f"{self.folder}/{name}" for name in self._unmerged(snapshot)]
        paths += [f"{snapshot}/totals"] if snapshot else []
        if not paths:
            return self.spark.createDataFrame([], DELTAS)
        return _summed(self.spark.read.schema(DELTAS).parquet(*paths))


def _summed(changes: DataFrame) -> DataFrame:
    sums = [F.sum(name).alias(name) for name in ("docs", "tokens", "chars")]
    by_key = changes.groupBy(*KEYS).agg(*sums)
    return by_key.filter("docs <> 0 OR tokens <> 0 OR chars <> 0")
