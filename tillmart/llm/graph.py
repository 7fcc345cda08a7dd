"""Connected components of a graph held in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import written


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, component: for each node of an edge the smallest node it can reach.

    Rounds of large and small stars: each node's larger neighbours are joined to its smallest
    one, then its smaller neighbours, until the edges are stars. Every round is a join and an
    aggregation that combines before its shuffle, and its result is written to the shared
    folder; only the count and a checksum of the edges come to the driver. Edges with a null
    end and loops are left out.
    """
    a, b = F.col(left), F.col(right)
    held = edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    held = written(held.distinct(), "edges")
    state = _checksum(held)
    while True:
        held = written(_small_star(_large_star(held)), "edges")
        now = _checksum(held)
        if now == state:
            break
        state = now
    nodes = held.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = held.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return nodes.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Join each node's larger neighbours to the smallest of it and its neighbours."""
    smallest = edges.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least"))
    joined = edges.join(smallest, edges["lo"] == smallest["at"], "left").select(
        "hi", F.coalesce("least", "lo").alias("lo")
    )
    return joined


def _small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    joined = edges.join(smallest, "hi")
    moved = joined.filter("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    kept = smallest.select("hi", F.col("least").alias("lo"))
    return moved.unionByName(kept).distinct()


def _checksum(edges: DataFrame) -> tuple:
    # Sums of 32-bit parts stay exact below 2**31 edges each; decimals carry them further.
    digest = F.xxhash64("hi", "lo")
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.pmod(digest, F.lit(1 << 31)).cast("decimal(38,0)"))
    ).first()
    return tuple(row)
