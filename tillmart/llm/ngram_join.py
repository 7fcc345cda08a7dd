"""Join of documents whose sets of word n-grams have a high Jaccard similarity.

Documents are compared in tiles, by falling size, so that a document meets only those of a
similar size. In a tile, hashed bitmaps of the sets bound the overlap of two documents from
above by their bit counts; where the bound allows a link, the sorted arrays of the sets are
intersected.

Which documents share a tile: an n-gram set is sorted by hash. Two similar sets agree on most
of their smallest hashes, so they hold, among their first `PROBES`, two that are neighbours in
both. Every document is sent to the tiles of its neighbouring pairs. For sets of at most
`PROBES` n-grams no link can be missed; for larger ones the chance to miss a given link is
below `MISS`. Tiles beyond BLOCK rows are split in blocks that meet pairwise.

Equal sets are one class from the start. Links within the candidates' connected groups are
found exactly, but documents known to be connected are not compared again, so a group of
near copies costs about one comparison for each of them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm import words as W
from tillmart.llm.common import (
    numbers,
    passing_tables,
    raw_bytes,
    slices,
    whole_groups,
    written,
)
from tillmart.llm.graph import components

MISS = 1e-9
BITMAP_WORDS = 16
BLOCK = 1024
ARRAY_BLOCK = 256
LEAST_SIMILARITY = 0.7

SKETCH = "doc_id long, n_shingles long, cls long, probes array<long>, bitmap binary"


def probes_needed(similarity: float, miss: float = MISS) -> int:
    """So many smallest hashes that two neighbours agree but with a chance below `miss`.

    Without two agreeing neighbours among k, each agreeing with the chance s, the chance
    falls by the larger root of x^2 = (1 - s) x + s (1 - s) with every further one.
    """
    rest = 1 - similarity
    if rest <= 0:
        return 2
    root = (rest + math.sqrt(rest * rest + 4 * similarity * rest)) / 2
    return max(2, math.ceil(math.log(miss) / math.log(root)) + 1)


# --- sets of n-grams ---------------------------------------------------------------


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """For each text its sorted distinct 64-bit hashes of `width` successive words.

    Words are runs of signs other than blank, tab to carriage return, with A to Z in lower
    case. Fewer words than `width` are one n-gram; no word gives an empty set.
    """
    hashed: list[list[np.ndarray]] = [[] for _ in texts]
    for owners, held in W.pieces(texts):
        joined = W.Texts(held)
        points = joined.points
        joined.points = np.where((points >= 65) & (points <= 90), points + 32, points)
        blank = (points == 32) | ((points >= 9) & (points <= 13))
        start = joined.is_first()
        start[1:-1] |= blank[1:] != blank[:-1]
        bounds = np.flatnonzero(start)
        keep = ~blank[bounds[bounds < len(points)]]
        starts, ends = bounds[:-1][keep[: len(bounds) - 1]], bounds[1:][keep[: len(bounds) - 1]]
        found = joined.hashes(starts, ends)
        at = np.searchsorted(starts, joined.first)
        for k, owner in enumerate(owners):
            if at[k + 1] > at[k]:
                hashed[owner].append(found[at[k] : at[k + 1]])
    factors = W.mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    sets = []
    for parts in hashed:
        row = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(row):
            sets.append(row)
            continue
        count = min(width, len(row))
        with np.errstate(over="ignore"):
            total = np.zeros(len(row) - count + 1, np.uint64) + np.uint64(count)
            for k in range(count):
                total += row[k : len(row) - count + 1 + k] * factors[k]
        sets.append(np.unique(W.mixed(total)))
    return sets


def _class_of(values: np.ndarray) -> int:
    """One 64-bit number for a whole set."""
    with np.errstate(over="ignore"):
        total = W.mixed(values + np.uint64(len(values))).sum(dtype=np.uint64)
        return int(W.mixed(np.atleast_1d(total))[0].view(np.int64))


def _bitmap(values: np.ndarray, words: int) -> np.ndarray:
    bits = np.zeros(words * 64, bool)
    bits[(values >> np.uint64(20)) % np.uint64(words * 64)] = True
    return np.packbits(bits).view(np.uint64)


def _sketch_task(
    batches: Iterable[pa.RecordBatch], width: int, probes: int
) -> Iterator[pa.RecordBatch]:
    factors = W.mixed(np.arange(11, 13, dtype=np.uint64)) | np.uint64(1)
    for batch in slices(batches):
        texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
        sets = shingle_sets(texts, width)
        classes, pairs, bitmaps = [], [], []
        with np.errstate(over="ignore"):
            for values in sets:
                classes.append(_class_of(values))
                head = values[:probes]
                near = W.mixed(head[:-1] * factors[0] + head[1:] * factors[1])
                pairs.append(near.view(np.int64))
                bitmaps.append(_bitmap(values, BITMAP_WORDS).tobytes())
        bounds = np.cumsum([0] + [len(p) for p in pairs]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(values) for values in sets], pa.int64()),
                pa.array(classes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(pairs))),
                pa.array(bitmaps, pa.binary()),
            ],
            ["doc_id", "n_shingles", "cls", "probes", "bitmap"],
        )


# --- comparisons in a tile ----------------------------------------------------------


def _bound(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """At most so many elements are common, by bits that one bitmap has and the other lacks."""
    only_a = np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def similar_pairs(
    tile: np.ndarray, n: np.ndarray, bitmaps: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one tile that sizes and bitmaps let be similar.

    Rows come sorted by tile and size. Each row meets the next, the one after, and so on until
    the tile or the band of sizes ends.
    """
    active = np.arange(len(tile))
    step = 0
    while len(active):
        step += 1
        active = active[active + step < len(tile)]
        other = active + step
        near = (tile[active] == tile[other]) & (100 * n[active] >= percent * n[other])
        active, other = active[near], other[near]
        for low in range(0, len(active), 1 << 16):
            a, b = active[low : low + (1 << 16)], other[low : low + (1 << 16)]
            most = _bound(bitmaps[a], bitmaps[b], n[a], n[b])
            found = 100 * most >= percent * (n[a] + n[b] - most)
            if found.any():
                yield a[found], b[found]


class Forest:
    """Sets of row numbers that can be joined."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


EDGES = "a long, b long"


def _edges(left: list[int], right: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"]
    )


def _candidate_task(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Edges that connect the classes of a tile that may be similar, no more than its rows."""
    for table in whole_groups(batches, "tile"):
        tile, n, cls = (numbers(table[c]) for c in ("tile", "n", "cls"))
        block = numbers(table["block"])
        data, _ = raw_bytes(table["bitmap"])
        bitmaps = data.view(np.uint64).reshape(len(tile), -1)
        order = np.lexsort((n, tile))
        tile, n, cls, block, bitmaps = (x[order] for x in (tile, n, cls, block, bitmaps))
        forest = Forest(len(tile))
        left, right = [], []
        for a, b in similar_pairs(tile, n, bitmaps, percent):
            for x, y in zip(a.tolist(), b.tolist()):
                if forest.join(x, y):
                    left.append(cls[x])
                    right.append(cls[y])
        yield _edges(left, right)


def _linked_rows(
    arrays: list[np.ndarray], labels: list[int], probes: list[bool], percent: int
) -> Iterator[tuple[int, int]]:
    """Pairs of rows of a tile that connect all linked rows; rows of one label are connected.

    If some rows are probes, only pairs of a probe and another row are compared.
    """
    order = sorted(range(len(arrays)), key=lambda row: len(arrays[row]))
    n = np.array([len(arrays[row]) for row in order], np.int64)
    words = min(1024, 1 << max(3, int(2 * n.max(initial=1) // 64).bit_length()))
    bitmaps = np.array([_bitmap(arrays[row], words) for row in order])
    forest = Forest(len(arrays))
    owner: dict[int, int] = {}
    for row, label in enumerate(labels):
        forest.join(owner.setdefault(label, row), row)
    any_probe = any(probes)
    for a, b in similar_pairs(np.zeros(len(order), np.int8), n, bitmaps, percent):
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = order[x], order[y]
            if any_probe and probes[x] == probes[y] or forest.root(x) == forest.root(y):
                continue
            common = len(np.intersect1d(arrays[x], arrays[y], assume_unique=True))
            if 100 * common >= percent * (len(arrays[x]) + len(arrays[y]) - common):
                forest.join(x, y)
                yield x, y


def _verify_task(
    batches: Iterable[pa.RecordBatch], percent: int, roots: bool
) -> Iterator[pa.RecordBatch]:
    """Edges between linked classes of a tile, or, as `roots`, each class and the one that
    stands for all classes of the tile it is connected with."""
    for table in whole_groups(batches, "tile"):
        tile = numbers(table["tile"])
        data, first = raw_bytes(table["hashes"])
        bounds = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
        cls, label, probe = (numbers(table[c]).tolist() for c in ("cls", "label", "probe"))
        left: list[int] = []
        right: list[int] = []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            arrays = [data[first[r] : first[r + 1]].view(np.uint64) for r in range(low, high)]
            pairs = _linked_rows(arrays, label[low:high], probe[low:high], percent)
            if roots:
                forest = Forest(high - low)
                for x, y in pairs:
                    forest.join(x, y)
                left += cls[low:high]
                right += [cls[low + forest.root(row)] for row in range(high - low)]
            else:
                for x, y in pairs:
                    left.append(cls[low + x])
                    right.append(cls[low + y])
        yield _edges(left, right)


def _arrays_task(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The sets of texts whose class is the one asked for."""
    for batch in slices(batches):
        texts = ["" if t is None else t for t in batch.column(2).to_pylist()]
        wanted = batch.column(0).to_numpy(zero_copy_only=False)
        keep, hashes = [], []
        for number, values in enumerate(shingle_sets(texts, width)):
            if _class_of(values) == wanted[number]:
                keep.append(number)
                hashes.append(values.tobytes())
        chosen = pa.array(keep, pa.int64())
        columns = [batch.column(0).take(chosen), batch.column(1).take(chosen)]
        columns.append(pa.array(hashes, pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, ["cls", "grp", "hashes"])


# --- the join ------------------------------------------------------------------------


def _blocks(count: Column, size: int) -> Column:
    return F.ceil(count / F.lit(size)).cast("int")


def _in_blocks(rows: DataFrame, key: str, count: str, size: int) -> DataFrame:
    """Adds `block` and `tile`: rows of a key with many rows meet in tiles of two blocks."""
    blocks = _blocks(F.col(count), size)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("cls", key), blocks).cast("int"))
    others = F.sequence(F.lit(0), blocks - 1)
    met = dealt.withColumn("other", F.explode(others))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return met.withColumn("tile", F.xxhash64(key, low, high))


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Edges between classes that may be similar."""
    probes = written(
        classes.select("cls", F.explode(F.array_distinct("probes")).alias("probe")), "probes"
    )
    shared = probes.groupBy("probe").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    rows = probes.join(shared, "probe")
    full = rows.join(classes.select("cls", F.col("n_shingles").alias("n"), "bitmap"), "cls")
    tiled = _in_blocks(full, "probe", "count", BLOCK).select("tile", "block", "cls", "n", "bitmap")
    return (
        tiled.repartition("tile")
        .sortWithinPartitions("tile")
        .mapInArrow(functools.partial(_candidate_task, percent=percent), EDGES)
    )


def _verified(rows: DataFrame, percent: int, roots: bool) -> DataFrame:
    """What `_verify_task` finds among the rows of each tile: tile, cls, label, probe, hashes."""
    return (
        rows.select("tile", "cls", "label", "probe", "hashes")
        .repartition("tile")
        .sortWithinPartitions("tile")
        .mapInArrow(functools.partial(_verify_task, percent=percent, roots=roots), EDGES)
    )


def _links(documents: DataFrame, reps: DataFrame, candidates: DataFrame, width: int, percent: int):
    """Edges that connect all classes with a link, found within the groups of candidates."""
    groups = components(candidates)
    counted = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    asked = (
        reps.join(groups.withColumnRenamed("node", "cls"), "cls")
        .select("cls", F.col("component").alias("grp"), F.col("rep").alias("asked_id"))
    )
    texts = asked.join(documents, asked["asked_id"].eqNullSafe(documents["doc_id"]))
    arrays = texts.select("cls", "grp", "text").mapInArrow(
        functools.partial(_arrays_task, width=width), "cls long, grp long, hashes binary"
    )
    arrays = arrays.join(counted.withColumnRenamed("component", "grp"), "grp")
    blocks = _blocks(F.col("size"), ARRAY_BLOCK)
    dealt = arrays.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    )
    dealt = written(dealt, "shingle-sets")
    alone = dealt.withColumns(
        {"tile": F.xxhash64("grp", "block"), "label": F.col("cls"), "probe": F.lit(False)}
    )
    roots = written(_verified(alone, percent, roots=True).distinct(), "roots")
    large = dealt.filter("blocks > 1")
    if large.isEmpty():
        return roots
    return written(roots.unionByName(_across(large, roots, percent)), "links")


def _across(large: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Edges between blocks of large groups, whose classes are connected with `roots`.

    First the roots of a group are compared with each other, in tiles of their own. Then all
    rows outside of the group's largest component so far, as probes, meet all rows of its
    blocks.
    """
    named = roots.select(F.col("a").alias("cls"), F.col("b").alias("label"))
    labelled = large.join(named, "cls")
    leaders = labelled.filter("cls = label").withColumn("probe", F.lit(False))
    tiles = F.ceil(F.col("blocks") / F.lit(64)).cast("int")
    apart = F.pmod(F.xxhash64(F.lit(7), "cls"), tiles)
    met = leaders.withColumn("tile", F.xxhash64("grp", apart, F.lit(7)))
    among = written(_verified(met, percent, roots=True).distinct(), "roots")
    raised = among.select(F.col("a").alias("label"), F.col("b").alias("top"))
    marked = labelled.join(raised, "label").drop("label").withColumnRenamed("top", "label")
    marked = written(marked, "labelled")
    sizes = marked.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("members"))
    main = sizes.groupBy("grp").agg(F.max(F.struct("members", "label"))["label"].alias("main"))
    ranked = marked.join(main, "grp")
    outside = ranked.filter("label <> main")
    chunks = outside.groupBy("grp").agg(_blocks(F.count(F.lit(1)), ARRAY_BLOCK).alias("chunks"))
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    probes = outside.join(chunks, "grp").withColumns(
        {
            "chunk": F.pmod(F.xxhash64(F.lit(9), "cls"), F.col("chunks")).cast("int"),
            "block": everywhere,
            "probe": F.lit(True),
        }
    )
    stay = ranked.join(chunks, "grp").withColumns(
        {"chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), "probe": F.lit(False)}
    )
    names = ["grp", "block", "chunk", "cls", "label", "probe", "hashes"]
    rows = probes.select(names).unionByName(stay.select(names))
    tiled = rows.withColumn("tile", F.xxhash64("grp", "block", "chunk"))
    return among.unionByName(_verified(tiled, percent, roots=False))


def similar_documents(
    documents: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and is_kept for every row.

    Two rows are linked if 100 * |A and B| >= percent * |A or B| for their sets of n-grams of
    `width` words. component_id is the smallest id reachable by links, the row's own included;
    is_kept is true where it is the row's own id. A text that is null, empty or without words
    has an empty set and links with nothing. Repeated rows share a class; with a repeated id
    they are all kept or all not. A null id links as any other, but is never the smallest; a
    component of null ids alone has a null component_id and is kept. Other columns are not
    read; an empty table gives no rows. `percent` must be at least 70.
    """
    if percent < 100 * LEAST_SIMILARITY:
        raise ValueError(f"percent must be at least {100 * LEAST_SIMILARITY:g}")
    chosen = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    with passing_tables(documents.sparkSession):
        return written(_joined(chosen, width, percent), "similar-documents", keep=True)


def _joined(chosen: DataFrame, width: int, percent: int) -> DataFrame:
    probes = probes_needed(percent / 100)
    sketch = chosen.mapInArrow(
        functools.partial(_sketch_task, width=width, probes=probes), SKETCH
    )
    sketch = written(sketch, "sketches")
    filled = sketch.filter("n_shingles > 0")
    classes = written(
        filled.groupBy("cls").agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("probes").alias("probes"),
            F.first("bitmap").alias("bitmap"),
        ),
        "classes",
    )
    reps = classes.select("cls", "rep")
    edges = _links(chosen, reps, _candidates(classes, percent), width, percent)
    linked = components(edges).select(F.col("node").alias("cls"), "component")
    whole = linked.join(reps, "cls").groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = linked.join(whole, "component").select("cls", "component_id")
    smallest = reps.join(by_class, "cls", "left").select(
        "cls", F.coalesce("component_id", "rep").alias("component_id")
    )
    rows = sketch.select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("cls")).alias("cls")
    )
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        rows.join(smallest, "cls", "left")
        .withColumn("component_id", component)
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("is_kept"),
        )
    )


# The result of `op5_ngram_join`, from all pairs with a common n-gram.
SQL_TEXT = r"""
    WITH RECURSIVE worded AS (
      SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
      FROM documents WHERE text IS NOT NULL),
    grams AS (
      SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) >= 4 THEN
               list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' '))
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS gram
      FROM worded),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
      FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
    links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
    reach AS (
      SELECT doc_id AS a, doc_id AS b FROM documents
      UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    found AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS is_kept
    FROM found LEFT JOIN sizes USING (doc_id)"""
