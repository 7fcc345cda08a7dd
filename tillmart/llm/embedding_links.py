"""Near-duplicate vectors by Euclidean hashing and exact cosines.

Vectors are scaled to length one. A hash is a quantised random projection,
floor((a . x + b) / w); near vectors agree on it more often. A table joins K hashes to one
bucket, and vectors that share a bucket of one of L tables are compared by exact cosine.

Two vectors at Euclidean distance d agree on a hash with the chance
p(d) = 1 - 2 N(-w/d) - 2 d / (sqrt(2 pi) w) * (1 - exp(-w^2 / (2 d^2))), and share a bucket
with 1 - (1 - p^K)^L: with w = 2, K = 10, L = 40 that is 0.998 at the cosine 0.9 and above
0.99999 from 0.95 on.

Equal vectors are one class from the start. A pair is counted in the first table in which it
meets, so no pair is written down: tasks give counts and edges that connect what is linked.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm import words as W
from tillmart.llm.common import numbers, passing_tables, whole_groups, written
from tillmart.llm.graph import components

COSINE = 0.9
WIDTH = 2.0
HASHES = 10
TABLES = 40
SEED = 20_240_601
BLOCK = 2048

FOUND = "cls long, root long, links long"


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, at least one of them not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


@functools.lru_cache(maxsize=8)
def _projections(dimension: int) -> tuple[np.ndarray, np.ndarray]:
    draws = np.random.default_rng([SEED, dimension])
    directions = draws.standard_normal((dimension, TABLES * HASHES))
    return directions, draws.uniform(0, WIDTH, TABLES * HASHES)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def bucket_numbers(vectors: np.ndarray) -> np.ndarray:
    """One 32-bit bucket number for each vector and table."""
    directions, shifts = _projections(vectors.shape[1])
    cells = np.floor((unit(vectors) @ directions + shifts) / WIDTH).astype(np.int64)
    cells = cells.reshape(len(vectors), TABLES, HASHES).astype(np.uint64)
    factors = W.mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        mixed = W.mixed((cells * factors).sum(axis=2, dtype=np.uint64))
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """The flat values of a list column, and the length of each list."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def _bucket_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, lengths = _lists(batch.column(1))
        first = np.cumsum(lengths) - lengths
        found = np.zeros((len(lengths), TABLES), np.int32)
        for dimension in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dimension)
            rows = values[first[at][:, None] + np.arange(dimension)]
            found[at] = bucket_numbers(rows)
        bounds = np.arange(len(lengths) + 1, dtype=np.int32) * TABLES
        buckets = pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), buckets], ["cls", "buckets"])


def _reach(linked: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches by links."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1)
        lower = np.minimum(label, near)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _compare_task(batches: Iterable[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """For the rows of each tile with links: how many, and a row that connects them."""
    for table in whole_groups(batches, "tile"):
        tile = numbers(table["tile"])
        bounds = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
        cls, copies, block, number = (
            numbers(table[c]) for c in ("cls", "copies", "block", "table")
        )
        across = numbers(table["across"])
        values, lengths = _lists(table["vector"])
        first = np.cumsum(lengths) - lengths
        buckets, counts = _lists(table["earlier"])
        begin = np.cumsum(counts) - counts
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if high - low < 2:
                continue
            dimension, earlier = int(lengths[low]), int(number[low])
            vectors = unit(
                values[first[low] : first[low] + dimension * (high - low)].reshape(-1, dimension)
            )
            linked = np.triu(vectors @ vectors.T >= cosine, 1)
            if across[low]:
                linked &= block[low:high, None] != block[None, low:high]
            a, b = np.nonzero(linked)
            if not len(a):
                continue
            if earlier:
                before = buckets[begin[low] : begin[low] + earlier * (high - low)]
                before = before.reshape(-1, earlier)
                for part in range(0, len(a), 1 << 16):
                    x, y = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
                    met = (before[x] == before[y]).any(axis=1)
                    linked[x[met], y[met]] = False
            linked |= linked.T
            rows = np.flatnonzero(linked.any(axis=1))
            if not len(rows):
                continue
            near = linked[np.ix_(rows, rows)]
            found = cls[low:high][rows]
            out.append((found, found[_reach(near)], near @ copies[low:high][rows]))
        if out:
            columns = [np.concatenate(parts) for parts in zip(*out)]
            arrays = [pa.array(c.astype(np.int64)) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, ["cls", "root", "links"])


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    A row's links are the other rows with a cosine of at least `cosine` to it; component_id is
    the smallest id reachable by links, the row's own included, and kept tells whether that is
    its own. Vectors that are null, empty or zero, or have a null or non-finite component, link
    with nothing; vectors of different lengths do not link. Equal vectors link, and a repeated
    row counts as a vector of its own. A null id is never the smallest. Other columns are not
    read; an empty table gives no rows.
    """
    chosen = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")
    )
    with passing_tables(vectors.sparkSession):
        return written(_linked(chosen, cosine), "near-vectors", keep=True)


def _linked(chosen: DataFrame, cosine: float) -> DataFrame:
    good = usable(F.col("vector"))
    rows = chosen.select("vec_id", F.when(good, F.xxhash64("vector")).alias("cls"))
    classes = (
        chosen.filter(good)
        .groupBy(F.xxhash64("vector").alias("cls"))
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vector").alias("vector"),
        )
    )
    classes = written(classes, "vector-classes")
    buckets = classes.select("cls", "vector").mapInArrow(_bucket_task, "cls long, buckets array<int>")
    buckets = written(buckets, "buckets")
    found = written(_compared(classes, buckets, cosine), "vector-links")
    by_class = found.groupBy("cls").agg(F.sum("links").alias("others"))
    linked = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    whole = (
        linked.withColumnRenamed("node", "cls")
        .join(classes.select("cls", "rep"), "cls")
        .groupBy("component")
        .agg(F.min("rep").alias("smallest"))
    )
    smallest = linked.join(whole, "component").select(F.col("node").alias("cls"), "smallest")
    told = (
        classes.select("cls", "rep", "copies")
        .join(by_class, "cls", "left")
        .join(smallest, "cls", "left")
        .select(
            "cls",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
            F.coalesce("smallest", "rep").alias("reached"),
        )
    )
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("reached"))
    return (
        rows.join(told, "cls", "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _compared(classes: DataFrame, buckets: DataFrame, cosine: float) -> DataFrame:
    """Links of the classes that share a bucket, in tiles of at most two blocks."""
    dimension = classes.select("cls", F.size("vector").alias("dimension"))
    spread = buckets.join(dimension, "cls").select(
        "cls", "dimension", F.posexplode("buckets").alias("table", "bucket")
    )
    spread = spread.select(
        "cls", "table", F.xxhash64("table", "dimension", "bucket").alias("key")
    )
    spread = written(spread, "bucket-rows")
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    blocks = F.ceil(F.col("count") / F.lit(BLOCK)).cast("int")
    dealt = (
        spread.join(shared, "key")
        .withColumn("block", F.pmod(F.xxhash64("cls", "key"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tiled = dealt.select(
        F.xxhash64("key", low, high).alias("tile"), (low < high).alias("across"), "block", "table", "cls"
    )
    full = tiled.join(classes.select("cls", "copies", "vector"), "cls").join(buckets, "cls")
    earlier = F.slice("buckets", F.lit(1), F.col("table"))
    rows = full.select(
        "tile", "across", "block", "table", "cls", "copies", "vector", earlier.alias("earlier")
    )
    return (
        rows.repartition("tile")
        .sortWithinPartitions("tile")
        .mapInArrow(functools.partial(_compare_task, cosine=cosine), FOUND)
    )


# The result of `op1_embedding_links`, from all pairs.
SQL_TEXT = """
    WITH RECURSIVE given AS (
      SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    usable AS (
      SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM given
      WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_inner_product(v, v) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
      ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
    reach AS (
      SELECT vec_id AS a, vec_id AS b FROM given
      UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
           (SELECT min(b) FROM reach WHERE a = vec_id) AS component_id,
           (SELECT min(b) FROM reach WHERE a = vec_id) = vec_id AS kept
    FROM given"""
