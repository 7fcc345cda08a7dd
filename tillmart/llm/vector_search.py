"""Exact top-k by inner product with a vector-approximation file.

Every vector is also kept as an approximation: one byte per component that names the cell of
a grid the component lies in. A scan of the approximations, in tiles of query blocks and
vector blocks, gives bounds of each score; the k-th best lower bound of a tile, and then that of
all tiles, rules out all vectors whose upper bound is below it. Exact vectors are then read in
the order of their upper bounds: first the k best, then all others that could still reach the
k-th exact score.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from tillmart.llm.common import numbers, passing_tables, whole_groups, written
from tillmart.llm.embedding_links import _lists
from tillmart.llm.whitening import usable

CELLS = 256
SCALE = 1024
QUERY_BLOCK = 512
VECTOR_BLOCK = 8192

# Sums below this are exact in doubles.
EXACT = float(1 << 53)
LONG = 1 << 63

BOUNDS = "qkey long, vkey long, vec_id long, most double, least double"
SCORES = "qkey long, query_id long, vkey long, vec_id long, score long, sorted string, near double"


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(1024 x) of doubles, which doubles hold exactly; infinite beyond their range."""
    with np.errstate(over="ignore"):
        return np.floor(values.astype(np.float64) * SCALE)


def exact_integer(x: float) -> int:
    """floor(1024 x) of any finite x."""
    return math.floor(x * SCALE) if abs(x) < EXACT else int(x) * SCALE


def sort_text(score: int) -> str:
    """A text that sorts as the integer does, of whatever size."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):05d}{digits}"
    turned = digits.translate(str.maketrans("0123456789", "9876543210"))
    return f"0{99_999 - len(digits):05d}{turned}"


def _quantise_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each vector its cells, and the grid they belong to."""
    for batch in batches:
        given, lengths = _lists(batch.column(batch.schema.get_field_index("vector")))
        first = np.concatenate([[0], np.cumsum(lengths)])
        values = scaled(given)
        largest = np.maximum.reduceat(np.abs(values), first[:-1])
        with np.errstate(over="ignore", invalid="ignore"):
            step = (2 * largest + 1) / CELLS
            cells = np.floor((values + np.repeat(largest, lengths)) / np.repeat(step, lengths))
        # Beyond the range of doubles the cells say nothing, and neither do the bounds.
        cells = np.clip(np.nan_to_num(cells), 0, CELLS - 1).astype(np.uint8)
        data = [cells[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(lengths.astype(np.int32)),
                pa.array(data, pa.binary()),
                pa.array(largest),
                pa.array(step),
            ],
            ["vec_id", "vkey", "dimension", "cells", "largest", "step"],
        )


def _bounds_task(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """For each query of a tile the vectors that may be among its k best there."""
    for table in whole_groups(batches, "tile"):
        tile = numbers(table["tile"])
        edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            part = table.slice(low, high - low)
            asked = part.filter(part["is_query"])
            stored = part.filter(pc.invert(part["is_query"]))
            if asked.num_rows and stored.num_rows:
                yield _tile_bounds(asked, _distinct_best(stored, k), k)


def _distinct_best(stored: pa.Table, k: int) -> pa.Table:
    """Of equal vectors only the rows of the k + 1 smallest ids: no other can be in a result."""
    ids, content = numbers(stored["vec_id"]), numbers(stored["content"])
    order = np.lexsort((numbers(stored["vkey"]), ids, content))
    new = np.concatenate([[True], content[order][1:] != content[order][:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return stored.take(pa.array(order[np.arange(len(order)) - start <= k]))


def _tile_bounds(asked: pa.Table, stored: pa.Table, k: int) -> pa.RecordBatch:
    values, lengths = _lists(asked["query"])
    queries = scaled(values).reshape(len(lengths), -1)
    data = b"".join(stored["cells"].to_pylist())
    cells = np.frombuffer(data, np.uint8).reshape(stored.num_rows, -1).astype(np.float64)
    step, largest = numbers(stored["step"]), numbers(stored["largest"])
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.abs(queries).sum(axis=1)[:, None]
        middle = (queries @ cells.T) * step + queries.sum(axis=1)[:, None] * (step / 2 - largest)
        # Half a cell in each component, and what rounding of doubles may add.
        slack = size * (step / 2 + 1e-12 * queries.shape[1] * (largest + step))
        known = np.isfinite(middle) & np.isfinite(slack)
        own = numbers(asked["vkey"])[:, None] == numbers(stored["vkey"])[None, :]
        least = np.where(own | ~known, -np.inf, middle - slack)
        most = np.where(own, -np.inf, np.where(known, middle + slack, np.inf))
    if stored.num_rows > k:
        kth = -np.partition(-least, k - 1, axis=1)[:, k - 1 : k]
    else:
        kth = np.full((len(lengths), 1), -np.inf)
    q, v = np.nonzero((most >= kth) & ~own)
    columns = [
        numbers(asked["vkey"])[q], numbers(stored["vkey"])[v], numbers(stored["vec_id"])[v],
        most[q, v], least[q, v],
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], ["qkey", "vkey", "vec_id", "most", "least"]
    )


def _scores_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact scores of pairs: in doubles where these hold every sum, else in Python's integers."""
    for batch in batches:
        queries, lengths = _lists(batch.column(4))
        vectors, _ = _lists(batch.column(5))
        first = np.concatenate([[0], np.cumsum(lengths)])
        a, b = scaled(queries), scaled(vectors)
        with np.errstate(over="ignore", invalid="ignore"):
            sums = np.add.reduceat(np.abs(a) * np.abs(b), first[:-1])
            plain = np.add.reduceat(a * b, first[:-1])
        scores = [
            int(total)
            if bound < EXACT
            else sum(
                exact_integer(x) * exact_integer(y)
                for x, y in zip(queries[low:high].tolist(), vectors[low:high].tolist())
            )
            for total, bound, low, high in zip(plain, sums, first[:-1], first[1:])
        ]
        # Beyond the range of doubles a lower bound.
        near = [float(s) if abs(s) < 1 << 1000 else 1e300 if s > 0 else -math.inf for s in scores]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:4],
                pa.array([s if -LONG <= s < LONG else None for s in scores], pa.int64()),
                pa.array([sort_text(s) for s in scores]),
                pa.array(near),
            ],
            ["qkey", "query_id", "vkey", "vec_id", "score", "sorted", "near"],
        )


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all vectors for each row `queries` picks.

    The score is the inner product of the vectors' integers, floor(1024 x); ties go to the
    smaller vec_id. All rows but the query's own are candidates, with fewer than k all are
    returned. Every row counts, a repeated one as well: an id in two rows is two candidates, and
    two queries. Rows with a null id, and vectors that are null, empty or have a component that
    is null or not finite, take no part. Vectors of another length than the query are no
    candidates. Ranks are exact whatever the size of the components; a score that does not fit
    a long is null. Other columns are not read; an empty table gives no rows.
    """
    rows = (
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            F.coalesce(queries, F.lit(False)).alias("is_query"),
        )
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        .withColumn("content", F.xxhash64("vector"))
        .withColumn("vkey", F.monotonically_increasing_id())
    )
    with passing_tables(vectors.sparkSession):
        # Written, so that a row keeps its number.
        return written(_best(written(rows, "vectors"), k), "top-k", keep=True)


def _best(rows: DataFrame, k: int) -> DataFrame:
    counts = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    n_vectors, n_queries = int(counts[0]), int(counts[1])
    bounds = written(_candidates(rows, n_vectors, n_queries, k), "bounds")
    candidates = possible(bounds, k)
    exact = rows.select("vkey", F.col("vector"))
    asked = rows.filter("is_query").select(
        F.col("vkey").alias("qkey"), F.col("vec_id").alias("query_id"), F.col("vector").alias("query")
    )

    def scored(chosen: DataFrame) -> DataFrame:
        read = chosen.join(exact, "vkey").join(asked, "qkey")
        pairs = read.select("qkey", "query_id", "vkey", "vec_id", "query", "vector")
        return pairs.mapInArrow(_scores_task, SCORES)

    by_bound = Over.partitionBy("qkey").orderBy(F.desc("most"), "vec_id", "vkey")
    ordered = written(candidates.withColumn("place", F.row_number().over(by_bound)), "order")
    first = written(scored(ordered.filter(F.col("place") <= k)), "first-read")
    # What rounding may have added to the least of the first scores is taken off.
    certain = first.groupBy("qkey").agg(F.min(F.col("near") - F.abs("near") * 1e-14).alias("kth"))
    rest = ordered.filter(F.col("place") > k).join(certain, "qkey").filter("most >= kth")
    best = Over.partitionBy("qkey").orderBy(F.desc("sorted"), "vec_id", "vkey")
    return (
        first.unionByName(scored(rest.drop("kth")))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def possible(bounds: DataFrame, k: int) -> DataFrame:
    """The candidates of which the upper bound reaches the k-th best lower bound of all tiles.

    Tasks keep the k best lower bounds of a query before they are shuffled.
    """
    best = Over.partitionBy("qkey").orderBy(F.desc("least"))
    top = bounds.select("qkey", "least").withColumn("place", F.row_number().over(best))
    kth = top.filter(F.col("place") <= k).groupBy("qkey").agg(
        F.count(F.lit(1)).alias("held"), F.min("least").alias("kth")
    )
    kth = kth.filter(F.col("held") == k).select("qkey", "kth")
    met = bounds.join(kth, "qkey", "left")
    return met.filter("kth IS NULL OR most >= kth").drop("kth")


def _upto(count: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def _candidates(rows: DataFrame, n_vectors: int, n_queries: int, k: int) -> DataFrame:
    """Bounds of the vectors that may be among the k best of a query."""
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    vector_blocks = max(1, -(-n_vectors // VECTOR_BLOCK))
    cells = rows.select("vec_id", "vkey", "vector").mapInArrow(
        _quantise_task,
        "vec_id long, vkey long, dimension int, cells binary, largest double, step double",
    )
    approximations = written(
        cells.join(rows.select("vkey", "content"), "vkey"), "approximations"
    )
    vector_block = F.pmod(F.xxhash64("vkey"), F.lit(vector_blocks))
    stored = approximations.select(
        F.lit(False).alias("is_query"), "vec_id", "vkey", "content", "cells", "largest", "step",
        F.lit(None).cast("array<double>").alias("query"), "dimension", vector_block.alias("vblock"),
        F.explode(_upto(query_blocks)).alias("qblock"),
    )
    asked = rows.filter("is_query").select(
        F.lit(True).alias("is_query"), "vec_id", "vkey", "content",
        F.lit(None).cast("binary").alias("cells"), F.lit(None).cast("double").alias("largest"),
        F.lit(None).cast("double").alias("step"), F.col("vector").alias("query"),
        F.size("vector").alias("dimension"),
        F.explode(_upto(vector_blocks)).alias("vblock"),
        F.pmod(F.xxhash64("vkey", F.lit(5)), F.lit(query_blocks)).alias("qblock"),
    )
    tile = F.xxhash64("qblock", "vblock", "dimension")
    return (
        stored.unionByName(asked)
        .withColumn("tile", tile)
        .drop("qblock", "vblock", "dimension")
        .repartition("tile")
        .sortWithinPartitions("tile")
        .mapInArrow(functools.partial(_bounds_task, k=k), BOUNDS)
    )


# The result of `op9_vector_search`, from all pairs.
SQL_TEXT = """
    WITH usable AS (
      SELECT vec_id, row_number() OVER () AS place,
        list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
      SELECT q.vec_id AS query_id, q.place AS asked, c.vec_id, c.place AS given,
        list_inner_product(q.v, c.v)::BIGINT AS score
      FROM usable q JOIN usable c ON q.place <> c.place AND len(q.v) = len(c.v)
      WHERE q.vec_id % 100 = 0),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id, given) AS rank_no
      FROM scores)
    SELECT query_id, rank_no::INT AS rank, vec_id, score FROM ranked WHERE rank_no <= 10"""
