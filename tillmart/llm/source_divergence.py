"""How far the sources of a language differ in their terms, by hash-consed segment trees.

Each language numbers its kept terms by falling count. A group, that is a source of a language,
has a segment tree of counts over these numbers. The leaves are cut into segments; a task holds
one segment of a block of groups, builds their trees bottom up and gives equal count subtrees one
node, wherever they occur and whichever group they are of. Two trees are walked together level by
level: each different pair of nodes is priced once, however often it occurs. The prices of the
segments are added up, which is what the levels above them would do.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import passing_tables, slices, written
from tillmart.operators.positions import with_positions

LEAST_DOCUMENTS = 30
MOST_TERM_RANKS = 50
UNIT = 1_000_000_000
SMOOTHING = 5

# Node pairs walked at once.
PAIRS_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Sizes:
    """What tasks hold: leaves of a segment (a power of two), groups of a block, counts.

    A task prices two blocks of one segment, and hands over counts when it holds so many.
    """

    segment: int = 4096
    block: int = 32
    counts: int = 400_000


# Bytes of terms: letters a-z, A-Z as a-z, and all of characters beyond ASCII.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

COUNTS = "lang string, source string, term string, count long, docs long"
PRICES = "lang string, segment long, left long, right long, leaf long, price long"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text: runs of letters a-z and of characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def _counts_task(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Counts of the terms of each group, and in how many documents; a null term for the group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in slices(batches, 200):
        for text, lang, source in zip(*(column.to_pylist() for column in batch.columns)):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(counts)
            found = terms_of(text)
            counts.update(found)
            docs.update(set(found))
            size += len(counts) - before
            if size >= most:
                yield from _handed_over(held)
                held, size = {}, 0
    yield from _handed_over(held)


def _handed_over(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        terms = list(counts)
        columns = [
            pa.array([lang] * (len(terms) + 1)),
            pa.array([source] * (len(terms) + 1)),
            pa.array([*(term.decode("utf-8", "replace") for term in terms), None], pa.string()),
            pa.array([*counts.values(), 0], pa.int64()),
            pa.array([*(docs[term] for term in terms), 0], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])


class Trees:
    """Segment trees of counts with one node for equal subtrees.

    `leaves` holds a row of counts for each tree, -1 where there is no term. Level 0 numbers the
    different counts; a node of a higher level is a different pair of nodes below it.
    """

    def __init__(self, leaves: np.ndarray):
        self.counts, nodes = np.unique(leaves, return_inverse=True)
        nodes = nodes.reshape(leaves.shape)
        self.below: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            width = int(nodes.max()) + 1
            pairs, inverse = np.unique(nodes[:, ::2] * width + nodes[:, 1::2], return_inverse=True)
            self.below.append((pairs // width, pairs % width))
            nodes = inverse.reshape(len(leaves), -1)
        self.roots = nodes[:, 0]

    def prices(self, left: np.ndarray, right: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """For pairs of trees the sum of |p - q| over their leaves.

        `shares[tree, count]` is the share of a count, by its place in `counts`. A pair of nodes
        is walked and priced once for each pair of trees.
        """
        tree = np.arange(len(left))
        a, b = self.roots[left], self.roots[right]
        ways = []
        for firsts, seconds in reversed(self.below):
            width = len(firsts) and int(max(firsts.max(), seconds.max())) + 1
            key = np.concatenate([
                (tree * width + firsts[a]) * width + firsts[b],
                (tree * width + seconds[a]) * width + seconds[b],
            ])
            distinct, inverse = np.unique(key, return_inverse=True)
            ways.append(inverse)
            tree, a, b = distinct // (width * width), distinct // width % width, distinct % width
        price = np.abs(shares[left[tree], a] - shares[right[tree], b])
        for inverse in reversed(ways):
            half = len(inverse) // 2
            price = price[inverse[:half]] + price[inverse[half:]]
        return price

    def found(self, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Leaves of a tree with a count above zero, and the counts' places, by walking down.

        Subtrees without any count are one node a level and are not entered.
        """
        empty = self.counts <= 0
        hollow = [empty]
        for firsts, seconds in self.below:
            hollow.append(hollow[-1][firsts] & hollow[-1][seconds])
        places, nodes = np.zeros(1, np.int64), self.roots[tree : tree + 1]
        for level in range(len(self.below), -1, -1):
            inside = ~hollow[level][nodes]
            places, nodes = places[inside], nodes[inside]
            if level:
                firsts, seconds = self.below[level - 1]
                places = np.concatenate([places * 2, places * 2 + 1])
                nodes = np.concatenate([firsts[nodes], seconds[nodes]])
        return places, nodes


def _shares(counts: np.ndarray, bases: list[int]) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / base) for each base and count; 0 where there is no term."""
    largest = int(counts.max(initial=0))
    if (largest + SMOOTHING) * UNIT < 1 << 62:
        tops = (counts + SMOOTHING) * UNIT
        told = np.array([1 + tops // base if base else np.zeros(len(tops), np.int64) for base in bases])
    else:
        rows = [[1 + (int(c) + SMOOTHING) * UNIT // base if base else 0 for c in counts] for base in bases]
        told = np.array(rows, np.int64)
    told[:, counts < 0] = 0
    return told


def _segment_prices(key: tuple, rows: pd.DataFrame, most: int, sizes: Sizes) -> pd.DataFrame:
    """Prices of the pairs of groups of two blocks in one segment, and terms of the groups.

    The row of number -1 is the language itself.
    """
    lang, segment, block, other = key
    rows = rows.sort_values("number", kind="stable").reset_index(drop=True)
    numbers = rows["number"].to_numpy()
    leaves = np.full((len(rows), sizes.segment), -1, np.int64)
    leaves[:, : int(rows["width"].iloc[0])] = 0
    for at, (places, counts) in enumerate(zip(rows["places"], rows["counts"])):
        if places is not None and len(places):
            leaves[at, np.asarray(places, np.int64)] = np.asarray(counts, np.int64)
    trees = Trees(leaves)
    shares = _shares(trees.counts, [int(base) for base in rows["base"]])
    of_block = numbers // sizes.block
    i, j = np.nonzero(
        (of_block[:, None] == block) & (of_block[None, :] == other) & (numbers[:, None] < numbers[None, :])
        & (numbers[:, None] >= 0)
    )
    step = max(1, PAIRS_AT_ONCE // sizes.segment)
    prices = [trees.prices(i[s : s + step], j[s : s + step], shares) for s in range(0, len(i), step)]
    out = [pd.DataFrame({
        "left": numbers[i], "right": numbers[j], "leaf": -1,
        "price": np.concatenate(prices) if prices else np.zeros(0, np.int64),
    })]
    if block == other:
        whole = np.flatnonzero(numbers == -1)
        for at in np.flatnonzero(of_block == block).tolist():
            places, nodes = trees.found(at)
            gain = shares[at, nodes] - shares[whole[0], np.searchsorted(trees.counts, leaves[whole[0], places])]
            places, gain = places[gain > 0], gain[gain > 0]
            if len(gain) > most:  # those below the 50th of the segment are in no report
                least = np.partition(gain, len(gain) - most)[len(gain) - most]
                places, gain = places[gain >= least], gain[gain >= least]
            out.append(pd.DataFrame({"left": numbers[at], "right": -1, "leaf": places, "price": gain}))
    told = pd.concat(out, ignore_index=True)
    return told.assign(lang=lang, segment=segment)


def divergence(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    most_ranks: int = MOST_TERM_RANKS,
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) group that occurs.

    A term is kept if it is in `least_documents` rows of its language; a group gives a kept term
    the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)). Part `pair` has one row for each other
    source of the language, with the sum of |p - q| over all kept terms, 0 without any; part
    `term` the `most_ranks` terms of the group that stand out most against the language.
    Ranks go by falling value, then by the item's bytes.

    Null text, lang and source are empty ones; texts may be of any length. Repeated rows count
    each, whatever their ids. Other columns are not read. An empty table gives no rows, and so
    does the part `pair` of a language with one source.
    """
    told = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    with passing_tables(docs.sparkSession):
        rows = _divergence(told, least_documents, most_ranks, sizes)
        return written(rows, "divergence", keep=True)


def _divergence(told: DataFrame, least_documents: int, most_ranks: int, sizes: Sizes) -> DataFrame:
    parts = told.mapInArrow(functools.partial(_counts_task, most=sizes.counts), COUNTS)
    counts = parts.groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )
    counts = written(counts, "term-counts")
    terms = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("count").alias("total"), F.sum("docs").alias("docs")
    )
    kept = terms.filter(F.col("docs") >= least_documents).select("lang", "term", "total")
    kept = _numbered(kept, [F.asc("lang"), F.desc("total"), F.asc("term")], "id")
    kept = written(kept, "kept-terms")
    found = counts.join(kept, ["lang", "term"]).select("lang", "source", "id", "count")
    found = written(found, "kept-counts")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("whole"))
    in_kept = found.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = counts.filter("term IS NULL").select("lang", "source")
    groups = _numbered(groups, [F.asc("lang"), F.asc("source")], "number")
    groups = (
        groups.join(in_kept, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang", "source", "number", F.coalesce("terms", F.lit(0)).alias("terms"),
            (F.coalesce("n", F.lit(0)) + SMOOTHING * F.coalesce("terms", F.lit(0))).alias("base"),
        )
    )
    groups = written(groups, "groups")

    prices = written(_prices(found, kept, groups, langs, most_ranks, sizes), "prices")
    terms = prices.withColumn("id", F.col("segment") * sizes.segment + F.col("leaf"))
    return _pair_rows(prices, groups).unionByName(_term_rows(terms, kept, groups, most_ranks))


def _numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with a number from 0 within their language, in an order that begins with it."""
    placed = with_positions(rows, order, "place")
    first = placed.groupBy("lang").agg(F.min("place").alias("first"))
    return placed.join(first, "lang").withColumn(name, F.col("place") - F.col("first")).drop("place", "first")


def _prices(
    found: DataFrame, kept: DataFrame, groups: DataFrame, langs: DataFrame, most_ranks: int, sizes: Sizes
) -> DataFrame:
    """Prices of pairs by segment, and the terms that stand out in it."""
    width = F.lit(sizes.segment).cast("long")
    segment = F.expr(f"id div {sizes.segment}").alias("segment")
    cells = F.collect_list(F.struct((F.col("id") % width).alias("place"), "count")).alias("cells")
    of_group = found.groupBy("lang", "source", segment).agg(cells)
    of_lang = kept.withColumnRenamed("total", "count").groupBy("lang", segment).agg(cells)

    every_segment = F.explode(F.expr(f"sequence(0L, (terms - 1) div {sizes.segment})"))
    rows = (
        groups.filter("terms > 0")
        .select("*", every_segment.alias("segment"))
        .join(of_group, ["lang", "source", "segment"], "left")
    )
    itself = of_lang.join(langs, "lang").withColumns(
        {"number": F.lit(-1).cast("long"), "base": F.col("whole") + SMOOTHING * F.col("terms")}
    )
    # A block meets every block of its language once: itself and those after it.
    blocks = groups.groupBy("lang").agg(F.expr(f"max(number) div {sizes.block}").alias("last"))
    own = F.expr(f"number div {sizes.block}")
    every = F.sequence(F.lit(0).cast("long"), F.col("last"))
    meetings = F.transform(
        every, lambda b: F.struct(F.least(own, b).alias("block"), F.greatest(own, b).alias("other"))
    )
    alone = F.transform(every, lambda b: F.struct(b.alias("block"), b.alias("other")))
    columns = [
        "lang", "segment", "number", "base",
        F.least(width, F.col("terms") - F.col("segment") * width).alias("width"), "cells",
    ]
    both = rows.join(blocks, "lang").select(*columns, F.explode(meetings).alias("meeting")).unionByName(
        itself.join(blocks, "lang").select(*columns, F.explode(alone).alias("meeting"))
    )
    placed = both.select(
        "lang", "segment", "meeting.block", "meeting.other", "number", "base", "width",
        F.col("cells.place").alias("places"), F.col("cells.count").alias("counts"),
    )
    task = functools.partial(_segment_prices, most=most_ranks, sizes=sizes)

    def priced(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return task(key, rows)

    return placed.groupBy("lang", "segment", "block", "other").applyInPandas(priced, PRICES)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def _pair_rows(prices: DataFrame, groups: DataFrame) -> DataFrame:
    summed = prices.filter("leaf < 0").groupBy("lang", "left", "right").agg(F.sum("price").alias("value"))
    # Without kept terms there are no segments, and every pair is worth 0.
    names = groups.select("lang", "number", "source", "terms")
    bare = names.filter("terms = 0")
    pairs = bare.alias("x").join(bare.alias("y"), "lang").filter("x.number < y.number")
    pairs = pairs.select(
        "lang", F.col("x.number").alias("left"), F.col("y.number").alias("right"),
        F.lit(0).cast("long").alias("value"),
    )
    each = summed.unionByName(pairs)
    swapped = each.select("lang", F.col("right").alias("left"), F.col("left").alias("right"), "value")
    named = each.unionByName(swapped)
    left = names.select("lang", F.col("number").alias("left"), "source")
    right = names.select("lang", F.col("number").alias("right"), F.col("source").alias("item"))
    rows = named.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    return _ranked(rows).withColumn("part", F.lit("pair")).select(COLUMNS)


def _term_rows(prices: DataFrame, kept: DataFrame, groups: DataFrame, most_ranks: int) -> DataFrame:
    leaf = prices.filter("leaf >= 0").select(
        "lang", F.col("left").alias("number"), "id", F.col("price").alias("value")
    )
    named = leaf.join(kept.select("lang", "id", F.col("term").alias("item")), ["lang", "id"])
    rows = named.join(groups.select("lang", "number", "source"), ["lang", "number"])
    best = _ranked(rows).filter(F.col("rank") <= most_ranks)
    return best.withColumn("part", F.lit("term")).select(COLUMNS)


# The result of `op13_source_divergence`.
SQL_TEXT = r"""
    WITH docs AS (
      SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
      FROM documents),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    occurring AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
    kept AS (
      SELECT lang, term, count(*) AS total FROM occurring GROUP BY lang, term
      HAVING count(DISTINCT doc) >= 30),
    sizes AS (SELECT lang, count(*) AS v, sum(total) AS whole FROM kept GROUP BY lang),
    counts AS (
      SELECT lang, source, term, count(*) AS c FROM occurring GROUP BY ALL),
    cells AS (
      SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, v, whole, total,
        sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n
      FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes s ON g.lang = s.lang
      LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    shares AS (
      SELECT lang, source, term, c,
        1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v)::HUGEINT AS p,
        1 + (1000000000::HUGEINT * (total + 5)) // (whole + 5 * v)::HUGEINT AS q
      FROM cells),
    sums AS (
      SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
      GROUP BY ALL),
    pairs AS (
      SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
    both_parts AS (
      SELECT * FROM pairs UNION ALL
      SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q),
    ranked AS (
      SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
      FROM both_parts)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""
