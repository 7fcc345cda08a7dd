"""Source divergence against counts in plain Python, and the trees against plain sums."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillmart.llm import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, count int, number int"


def divergence(spark, rows, **options):
    given = spark.createDataFrame([(n, *r, "t", 1, 2) for n, r in enumerate(rows)], SCHEMA)
    found = source_divergence.divergence(given.repartition(3), **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(row) for row in found.collect())


def brute(rows, least=30, most=50):
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        langs[lang].add(source)
    wanted = []
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(told):
            base = sum(told[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (told[t] + 5) // base for t in kept}

        whole = sum((counts[lang, s] for s in sources), Counter())
        q, p = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources - {s}]
            gains = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, told in (("pair", sorted(pairs)), ("term", sorted(gains)[:most])):
                wanted += [(lang, s, part, item, -v, n) for n, (v, _, item) in enumerate(told, 1)]
    return sorted(wanted)


def corpus(seed, count=400, sources=5, vocabulary=90):
    draw = np.random.default_rng(seed)
    words = [f"{c}{'ß' * (n % 3)}{d}" for n, (c, d) in enumerate(zip("aZéж中" * 40, "bcQxyz" * 40))]
    words = sorted(set(words))[:vocabulary]
    rows = []
    for _ in range(count):
        lang = ["en", "fr", None][draw.integers(3)]
        source = f"s{int(draw.integers(sources) * draw.random())}"
        picked = (draw.random(draw.integers(0, 60)) ** 2 * len(words)).astype(int)
        rows.append((" ".join(words[i] for i in picked), lang, source))
    return rows


def test_against_plain_counts(spark):
    rows = corpus(1)
    assert divergence(spark, rows) == brute(rows)


@pytest.mark.parametrize("segment, block, held", [(4, 2, 50), (16, 1, 10**6), (4096, 3, 1000)])
def test_segments_and_blocks(spark, segment, block, held):
    rows, sizes = corpus(2), source_divergence.Sizes(segment, block, held)
    assert divergence(spark, rows, least_documents=5, most_ranks=7, sizes=sizes) == brute(rows, 5, 7)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "en", ""), ("12 !!", "en", "a"), ("Same same", "en", "b")]
    rows += [("same SAME ÄB äb", "fr", s) for s in ("x", "y", None, "x")] * 10
    rows += [("word " * 200_000, "fr", "long"), ("\x00nul\x7fa_b", "fr", "x")]
    found = divergence(spark, rows)
    assert found == brute(rows)
    assert ("en", "a", "pair", "b", 0, 2) in found  # no term of the language is kept
    assert divergence(spark, []) == []


def test_ties_go_by_bytes(spark):
    rows = [("b z é", "en", "one"), ("q", "en", "two")] * 40
    found = [r for r in divergence(spark, rows) if r[1] == "one" and r[2] == "term"]
    assert [r[3] for r in found] == ["b", "z", "é"] and [r[5] for r in found] == [1, 2, 3]


def test_trees_share_nodes_and_price_like_plain_sums():
    draw = np.random.default_rng(3)
    leaves = np.zeros((6, 64), np.int64)
    leaves[:4, :20] = draw.integers(0, 3, (4, 20))
    leaves[4] = leaves[1]
    leaves[:, 61:] = -1
    trees = source_divergence.Trees(leaves)
    assert trees.roots[4] == trees.roots[1]
    assert len(trees.below[0][0]) <= 9 + 2  # pairs of three counts, and the ends without terms
    shares = source_divergence._shares(trees.counts, [100, 200, 300, 400, 200, 7])
    plain = np.array([shares[t, np.searchsorted(trees.counts, leaves[t])] for t in range(6)])
    left, right = np.triu_indices(6, 1)
    wanted = np.abs(plain[left] - plain[right]).sum(axis=1)
    assert trees.prices(left, right, shares).tolist() == wanted.tolist()
    for tree in range(6):
        places, nodes = trees.found(tree)
        assert sorted(places.tolist()) == np.flatnonzero(leaves[tree] > 0).tolist()
        assert (trees.counts[nodes] == leaves[tree][places]).all()


def test_shares_of_huge_counts_are_exact():
    counts = np.array([-1, 0, 10**15 + 7])
    found = source_divergence._shares(counts, [3 * 10**15 + 1])
    assert found.tolist() == [[0, 1 + 5 * 10**9 // (3 * 10**15 + 1), 1 + (10**15 + 12) * 10**9 // (3 * 10**15 + 1)]]
