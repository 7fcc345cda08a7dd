"""Joins of documents, lines and vectors, and graph components, against brute force."""

from __future__ import annotations

import random
import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmart.llm import common, embedding_links, graph, line_dedup, ngram_join, vector_search


def reach(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    pairs = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)]
    pairs += [(100 + n, 101 + n) for n in range(40)] + [(5, 5), (None, 3)]
    found = graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    nodes = {n for pair in real for n in pair}
    assert {r.node: r.component for r in found} == reach(nodes, real)
    assert len(found) == len(nodes)


def test_components_of_a_hub(spark):
    pairs = [(n, 5000) for n in range(3000)]
    found = graph.components(spark.createDataFrame(pairs, "a long, b long"))
    assert found.filter("component = 0").count() == 3001


# --- documents ----------------------------------------------------------------------

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def brute(texts, width, percent):
    sets = {n: shingles(t, width) for n, t in texts.items()}
    pairs = [
        (a, b)
        for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {n: (len(sets[n]), c) for n, c in reach(sets, pairs).items()}


def edited(draw, words, rate):
    return [draw.choice(VOCABULARY) if draw.random() < rate else w for w in words]


VOCABULARY = [f"w{n}" for n in range(300)] + ["Über", "\x1cx", "é"]


def corpus(draw, count):
    texts = {}
    while len(texts) < count:
        base = [draw.choice(VOCABULARY) for _ in range(draw.choice([1, 3, 4, 7, 12, 40, 120]))]
        for _ in range(draw.choice([1, 1, 2, 6])):
            words = edited(draw, base, draw.choice([0, 0.01, 0.03, 0.2]))
            if draw.random() < 0.3:
                words = [w.upper() if w.isascii() else w for w in words]
            texts[len(texts)] = draw.choice([" ", "\n", " \t "]).join(words)
    return texts


def found_documents(spark, rows, **options):
    schema = "doc_id long, text string, cls int, component_id string"
    given = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    return ngram_join.similar_documents(given, **options).collect()


@pytest.mark.parametrize("seed, width, percent", [(1, 4, 85), (2, 5, 80), (3, 2, 70), (4, 3, 100)])
def test_similar_documents(spark, seed, width, percent):
    texts = corpus(random.Random(seed), 120)
    rows = found_documents(spark, list(texts.items()), width=width, percent=percent)
    wanted = brute(texts, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == wanted
    assert all(r.is_kept == (r.doc_id == r.component_id) for r in rows)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "ARRAY_BLOCK", 4)
    draw = random.Random(8)
    chain = [draw.choice(VOCABULARY) for _ in range(60)]
    texts = {}
    for n in range(60):  # each close to the next, the ends far apart
        chain[draw.randrange(60)] = f"new{n}"
        texts[n] = " ".join(chain)
    other = [draw.choice(VOCABULARY) for _ in range(30)]
    for n in range(60, 90):
        texts[n] = " ".join([*other, f"tail{n}"])
    rows = found_documents(spark, list(texts.items()), width=3, percent=80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, 3, 80)


def test_documents_with_nulls_and_repeats(spark):
    text = "a b c d e f g h i j"
    rows = [(1, None), (2, ""), (3, " \n"), (5, text), (4, text), (4, text), (None, text), (None, "z"),
            (9, "x y"), (8, "X  Y"), (7, "q " * 300_000)]
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found_documents(spark, rows))
    assert found == sorted(
        [("1", 0, "1"), ("2", 0, "2"), ("3", 0, "3"), ("5", 6, "4"), ("4", 6, "4"), ("4", 6, "4"),
         ("None", 6, "4"), ("None", 1, "None"), ("9", 1, "8"), ("8", 1, "8"), ("7", 1, "7")]
    )
    assert found_documents(spark, []) == []


def test_bounds_never_hide_a_link():
    draw = np.random.default_rng(2)
    for _ in range(50):
        a = draw.integers(0, 1 << 62, 80).astype(np.uint64)
        b = np.concatenate([a[: draw.integers(0, 80)], draw.integers(0, 1 << 62, 20).astype(np.uint64)])
        maps = np.array([ngram_join._bitmap(x, 4) for x in (a, b)])
        most = ngram_join._bound(maps[:1], maps[1:], np.array([len(a)]), np.array([len(b)]))
        assert most[0] >= len(np.intersect1d(a, b))


def test_probes_needed():
    assert ngram_join.probes_needed(0.85) < ngram_join.probes_needed(0.8) < 40
    with pytest.raises(ValueError):
        ngram_join.similar_documents(None, percent=50)


# --- lines ----------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        last, row[0] = row[0], row[0] + 1
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance(spark, edits):
    draw = random.Random(edits)
    pairs = []
    for _ in range(150):
        a = [draw.choice("abé🙂") for _ in range(draw.randint(0, 12))]
        b = list(a)
        for _ in range(draw.randint(0, edits + 2)):
            at = draw.randint(0, len(b))
            b[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "é", "🙂"])
        pairs.append(("".join(a), "".join(b)))
    given = spark.createDataFrame(pairs, "a string, b string")
    rows = given.select("a", "b", line_dedup.within_edits(given["a"], given["b"], edits).alias("near"))
    for row in rows.collect():
        assert row.near == (distance(row.a, row.b) <= edits), (row.a, row.b)


def brute_lines(rows, min_chars, edits=2, long_chars=64):
    first = {}
    for doc, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if len(line) >= min_chars:
                first[line] = min(first.get(line, (doc, n)), (doc, n))
    lines = list(first)
    pairs = [
        (a, b)
        for a, b in combinations(range(len(lines)), 2)
        if distance(lines[a], lines[b]) <= (edits if min(len(lines[a]), len(lines[b])) >= long_chars else 1)
    ]
    root = reach(range(len(lines)), pairs)
    kept = {}
    for k, line in enumerate(lines):
        kept[root[k]] = min(kept.get(root[k], first[line]), first[line])
    keep = {line: kept[root[k]] for k, line in enumerate(lines)}
    wanted = {}
    for doc, text in rows:
        every = (text or "").split("\n")
        stay = [x for n, x in enumerate(every) if len(x) < min_chars or keep[x] == (doc, n)]
        wanted[doc] = None if text is None else "\n".join(stay)
    return wanted


def cleaned(spark, rows, min_chars, **options):
    schema = "doc_id long, text string, number int, dropped string, n_lines int"
    given = spark.createDataFrame([(*r, 1, "x", 9) for r in rows], schema)
    found = line_dedup.dedup_lines(given, min_chars=min_chars, **options)
    assert found.columns == ["doc_id", "text", "number", "dropped", "n_lines", "n_dropped"]
    return found.collect()


@pytest.mark.parametrize("edits, few", [(1, 8), (2, 1), (3, 8)])
def test_repeated_lines(spark, monkeypatch, edits, few):
    """With `few` at 1 all shared keys are split as long as anything is left to split."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    draw = random.Random(edits + few)
    bases = ["".join(draw.choice("abcdé 🙂") for _ in range(draw.randint(6, 30))) for _ in range(12)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(draw.randint(0, 6)):
            line = draw.choice(bases)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                at = draw.randint(0, len(line))
                line = line[:at] + draw.choice(["", "a", "x", "é"]) + line[at + draw.randint(0, 1) :]
            lines.append(line)
        rows.append((doc, "\n".join(lines)))
    wanted = brute_lines(rows, 8, edits, 16)
    assert edits == 1 or wanted != brute_lines(rows, 8, 1, 16)
    found = cleaned(spark, rows, 8, edits=edits, long_chars=16)
    assert {r.doc_id: r.text for r in found} == wanted
    for row in found:
        text = dict(rows)[row.doc_id]
        assert row.n_lines == text.count("\n") + 1
        assert row.n_lines - row.n_dropped == (row.text.count("\n") + 1 if row.text or row.n_lines > row.n_dropped else 0)


def test_many_numbered_lines_are_told_apart(spark):
    """Lines that share most of their signs meet only where few signs are left open."""
    template = "this notice about item {:09d} is the same in all documents but for the number of the item"
    lines = [template.format(n * 7_654_321 % 999_999_937) for n in range(120)]
    rows = [(n, line) for n, line in enumerate(lines)] + [(120, lines[5].replace("notice", "no tices"))]
    wanted = brute_lines(rows, 32)
    assert {r.doc_id: r.text for r in cleaned(spark, rows, 32)} == wanted
    assert wanted[120] == "" and sum(not text for text in wanted.values()) < 20


def test_near_lines_of_a_key_meet_one_of_them(spark):
    """Lines that differ in two signs all share keys; pairs grow with the lines, not their square."""
    line = "all rights to this text and to what is made of it are reserved by its author, number {:02d}"
    rows = [(n, line.format(n)) for n in range(80)] + [(80, line.format(5) + "1")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    sides = "array(struct(0 AS at, 2 AS own, 2 AS target, 2 AS edits))"
    keyed = ["xxhash64(text) AS cls", "1L AS key", "doc_id < 80 AS indexed", f"{sides} AS sides"]
    told = given.selectExpr(*keyed).select("cls", "key", "indexed", *line_dedup._left(F.col("sides")))
    lines = given.selectExpr("xxhash64(text) AS cls", "text AS line")
    pairs = line_dedup._told_apart(told, lines, 2)
    assert sum(found.count() for found in pairs) <= len(rows)
    assert {r.doc_id: r.text for r in cleaned(spark, rows, 32)} == brute_lines(rows, 32)


def test_lines_and_keys_are_shuffled_once(spark, monkeypatch):
    """No intermediate table has a row for each key or the text of each line."""
    sizes = {}

    def counted(df, label, keep=False):
        table = written(df, label, keep)
        sizes[label] = max(sizes.get(label, 0), table.count() * ("line" in table.columns or "key" in table.columns))
        return table

    written = line_dedup.written
    monkeypatch.setattr(line_dedup, "written", counted)
    draw = random.Random(3)
    rows = [(n, "".join(draw.choice("abcdefgh") for _ in range(90))) for n in range(300)]
    rows.append((300, rows[7][1] + "x"))
    found = {r.doc_id: r.text for r in cleaned(spark, rows, 32)}
    assert found == dict(rows) | {300: ""}
    assert max(sizes.values()) < 30


def test_shuffle_files_go_with_their_query(spark):
    setting = common.SHUFFLE_CLEANUP
    before = spark.conf.get(setting, "false")
    with common.passing_tables(spark):
        assert spark.conf.get(setting) == "true"
    assert spark.conf.get(setting) == before


@pytest.mark.parametrize("extra", [0, 1, 2])
def test_lines_around_the_longest_plain_ones(spark, extra):
    draw = random.Random(extra)
    line = "".join(draw.choice("abcd é🙂") for _ in range(line_dedup.PLAIN_CHARS - 1 + extra))
    rows = [(1, line), (2, line[:40] + line[41:]), (3, "xé" + line), (4, "xyz" + line[1:]), (5, line[::-1])]
    assert {r.doc_id: r.text for r in cleaned(spark, rows, 32)} == brute_lines(rows, 32)


def test_years_in_long_lines(spark):
    line = "Copyright {} by the authors of this text, all rights are reserved by them"
    rows = [(1, line.format(2019)), (2, line.format(2024)), (3, line.format(2035) + "\nthe rest")]
    found = {r.doc_id: r.text for r in cleaned(spark, rows, 32)}
    assert found == {1: rows[0][1], 2: "", 3: "the rest"}


def test_lines_with_nulls_and_repeats(spark):
    line, long = "a line of some length", "yes " * 200_000
    rows = [(2, line), (1, f"top\n{line}\n\n{line}"), (3, None), (4, ""), (5, f"{line}!\nend"), (6, long),
            (None, "of no id, but with a line")] + [(7, "repeated rows stay"), (7, "repeated rows stay")]
    found = sorted((str(r.doc_id), r.text) for r in cleaned(spark, rows, 8) if r.text is not None)
    assert found == sorted(
        [("2", ""), ("1", f"top\n{line}\n"), ("4", ""), ("5", "end"), ("6", long),
         ("None", "of no id, but with a line"), ("7", "repeated rows stay"), ("7", "repeated rows stay")]
    )
    assert cleaned(spark, [], 8) == []


def test_lines_use_no_python(spark):
    given = spark.createDataFrame([], "doc_id long, text string")
    plan = line_dedup.dedup_lines(given)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))


# --- vectors --------------------------------------------------------------------------


def near_rows(spark, rows, **options):
    schema = "vec_id long, embedding array<double>, cls int, copies string"
    given = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    return embedding_links.near_vectors(given, **options).collect()


def vectors(seed, groups, dimension=24):
    draw = np.random.default_rng(seed)
    rows = []
    for size, spread in groups:
        center = draw.standard_normal(dimension)
        for _ in range(size):
            rows.append((len(rows), (center + spread * draw.standard_normal(dimension)).tolist()))
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_links, "BLOCK", block)
    rows = vectors(1, [(60, 0.05), (30, 0.2), (10, 0.0), *[(1, 1)] * 100])
    unit = embedding_links.unit(np.array([v for _, v in rows]))
    linked = unit @ unit.T >= 0.9
    pairs = [(a, b) for a, b in combinations(range(len(rows)), 2) if linked[a, b]]
    root = reach(range(len(rows)), pairs)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_rows(spark, rows)}
    assert found == {n: (int(linked[n].sum()) - 1, root[n], root[n] == n) for n in range(len(rows))}


def test_vectors_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, nan]), (4, [1.0, inf]), (5, [1.0, None]), (6, []),
            (7, [1.0, 2.0]), (8, [2.0, 4.0]), (8, [2.0, 4.0]), (None, [1.0, 2.0]), (9, [1.0, 2.0, 0.0]),
            (10, [1e300, 2e300]), (11, [1e-300, 2e-300])]
    found = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in near_rows(spark, rows))
    alone = [(str(n), 0, str(n)) for n in (1, 2, 3, 4, 5, 6, 9)]
    linked = [("7", 5, "7"), ("8", 5, "7"), ("8", 5, "7"), ("None", 5, "7"), ("10", 5, "7"), ("11", 5, "7")]
    assert found == sorted(alone + linked)
    assert near_rows(spark, []) == []


def test_recall_of_hashing():
    """At the cosine 0.9 itself, two vectors share a bucket nearly always."""
    draw = np.random.default_rng(5)
    a = embedding_links.unit(draw.standard_normal((2000, 64)))
    across = draw.standard_normal((2000, 64))
    across = embedding_links.unit(across - (across * a).sum(axis=1, keepdims=True) * a)
    b = 0.9 * a + np.sqrt(1 - 0.81) * across
    same = embedding_links.bucket_numbers(a) == embedding_links.bucket_numbers(b)
    assert same.any(axis=1).mean() > 0.99
    assert same[:, :].mean() < 0.3


# --- search -----------------------------------------------------------------------------


def searched(spark, rows, k=10):
    schema = "vec_id long, embedding array<double>, vector int, query string"
    given = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    found = vector_search.top_k(given, given["vec_id"] % 7 == 0, k)
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()), key=str)


def brute_search(rows, k=10):
    """Every row is a query and a candidate of its own; rows without an id or of bad values are none."""
    whole = []
    for key, vector in rows:
        if key is not None and vector and all(x is not None and np.isfinite(x) for x in vector):
            whole.append((key, [int(np.floor(Fraction(x) * 1024)) for x in vector]))
    wanted = []
    for at, (query, q) in enumerate(whole):
        if query % 7 == 0:
            scores = sorted(
                (-sum(x * y for x, y in zip(q, v)), n)
                for other, (n, v) in enumerate(whole)
                if other != at and len(v) == len(q)
            )
            fits = [(n, -s if -(1 << 63) <= -s < 1 << 63 else None) for s, n in scores[:k]]
            wanted += [(query, r, n, s) for r, (n, s) in enumerate(fits, 1)]
    return sorted(wanted, key=str)


@pytest.mark.parametrize("blocks", [(512, 8192), (4, 16)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(vector_search, "VECTOR_BLOCK", blocks[1])
    rows = vectors(3, [(40, 0.0), (30, 0.01), (20, 0.3), *[(1, 1)] * 60])
    rows += [(1000 + n, [0.5] * 24) for n in range(30)] + [(2001, [0.0] * 24), (2002, [1e6] * 24)]
    assert searched(spark, rows) == brute_search(rows)


def test_few_candidates_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.5]), (1, [0.3, 0.1]), (7, [1.0, 2.0, 3.0]), (14, [0.0, 0.0])]
    odd = [(2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0])]
    assert searched(spark, rows + odd) == brute_search(rows)
    assert searched(spark, []) == []


def test_repeated_rows_are_rows(spark):
    rows = [(0, [1.0, -2.5]), (1, [0.3, 0.1]), (1, [0.3, 0.1]), (0, [1.0, -2.5]), (2, [2.0, 2.0]), (7, [1.0, 1.0])]
    found = searched(spark, rows)
    assert found == brute_search(rows)
    assert sum(r[0] == 7 and r[2] == 1 for r in found) == 2  # both rows of the vector
    assert sum(r[0] == r[2] == 0 for r in found) == 2  # each query row has the other as candidate
    many = rows + [(n + 10, [1.0, 1.0]) for n in range(40)] + [(5, [1.0, 1.0])] * 40
    assert searched(spark, many) == brute_search(many)


@pytest.mark.parametrize("size", [4e6, 1e13, 1e20, 3e38, 1e200, 1.7e308])
def test_large_finite_components_take_part(spark, size):
    draw = np.random.default_rng(int(np.log10(size)))
    rows = [(n, (draw.standard_normal(5) * 3).tolist()) for n in range(40)]
    rows += [(n + 100, [size, -size / 3, 1.0, 0.0, float(n)]) for n in range(15)]
    rows += [(n + 200, [-size / 2, 0.5, size / 7, 0.0, float(n)]) for n in range(15)]
    assert searched(spark, rows) == brute_search(rows)


def test_sort_texts_sort_as_integers():
    given = [0, -1, 1, 9, 10, -9, -10, 99, -99, 1 << 63, -(1 << 63), 10**300, -(10**300), 10**300 + 1]
    assert sorted(given) == sorted(given, key=vector_search.sort_text)


def test_more_blocks_leave_no_more_candidates(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(n, draw.standard_normal(16).tolist(), n % 100 == 0) for n in range(3000)]
    given = spark.createDataFrame(rows, "vec_id long, vector array<double>, is_query boolean")
    given = given.withColumns({"content": F.xxhash64("vector"), "vkey": F.col("vec_id")})
    counts = {}
    for size in (3000, 150):
        monkeypatch.setattr(vector_search, "VECTOR_BLOCK", size)
        bounds = vector_search._candidates(given, 3000, 30, 10).cache()
        counts[size] = (bounds.count(), vector_search.possible(bounds, 10).count())
    assert counts[150][0] > 3 * counts[3000][0]
    assert counts[150][1] <= 1.05 * counts[3000][1]


def test_bounds_hold():
    draw = np.random.default_rng(1)
    values = draw.integers(-2000, 2000, (50, 16)).astype(float)
    largest = np.abs(values).max(axis=1)
    step = (2 * largest + 1) / vector_search.CELLS
    cells = np.clip(np.floor((values + largest[:, None]) / step[:, None]), 0, 255)
    middle = cells * step[:, None] + step[:, None] / 2 - largest[:, None]
    assert (np.abs(values - middle) <= step[:, None] / 2 + 1e-9).all()
