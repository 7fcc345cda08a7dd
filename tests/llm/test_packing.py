"""Packing: every id once, in windows of the right lengths."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillmart.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
WORDS = "the cat and a dog's 12 houses, Über-straße naïve 中文 !!".split()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer):
    """texts: by id, with one text each."""
    wanted = {
        key: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for key, text in texts.items()
    }
    found = {key: {} for key in texts}
    by_window = {}
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4")
        assert len(ids) == row.length > 0 and row.doc_tokens == len(wanted[row.doc_id])
        assert row.start not in found[row.doc_id]
        found[row.doc_id][row.start] = ids
        by_window.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for key, parts in found.items():
        starts = sorted(parts)
        assert starts == [int(x) for x in np.cumsum([0] + [len(parts[s]) for s in starts])[:-1]]
        assert np.concatenate([parts[s] for s in starts]).tolist() == wanted[key].tolist()
    for pieces in by_window.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)
    return by_window


def documents(spark, rows, partitions=2):
    schema = "doc_id long, text string, ids string, offset int"
    return spark.createDataFrame([(*r, "x", 3) for r in rows], schema).repartition(partitions)


def test_mixed_documents(spark, tokenizer):
    draw = np.random.default_rng(3)
    texts = {n: " ".join(draw.choice(WORDS, draw.integers(0, 900))) for n in range(150)}
    texts |= {900: None, 901: "", 902: " \n\t ", 903: " ".join(draw.choice(WORDS, 30_000))}
    texts |= {904: "a <|endoftext|> b<|startoftext|>", 905: "ΟΔΟΣ İstanbul é", 906: "x" * 5000}
    rows = packing.pack(documents(spark, list(texts.items())), PATH).collect()
    windows = check(rows, texts, tokenizer)
    short = [w for w in windows.values() if sum(n for _, n in w) < 2048]
    assert len(short) <= 2 * 11


def test_repeated_rows_and_null_ids(spark):
    rows = packing.pack(documents(spark, [(1, "the cat"), (1, "the cat"), (None, "a dog")], 1), PATH)
    lengths = {}
    for row in rows.collect():
        lengths[row.doc_id] = lengths.get(row.doc_id, 0) + row.length
    assert lengths == {1: 6, None: 3}


def test_large_ids_beside_a_null(spark):
    large = (1 << 62) + 1
    rows = packing.pack(documents(spark, [(large, "a"), (None, "b")], 1), PATH).collect()
    assert {r.doc_id for r in rows} == {large, None}


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_ids_are_the_library_s(tokenizer):
    draw = np.random.default_rng(5)
    signs = ["a", "B", "'s", "'LL", " ", "\n", "12", "é", "É", "中", "!", "?!", "\x1c", "Σ", "ǆ", "ﬁ", "ஃ", "Ꟛ"]
    texts = ["".join(draw.choice(signs, draw.integers(0, 30))) for _ in range(400)]
    found = packing.word_ids(PATH).ids(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("seed", range(4))
def test_least_squares(seed):
    draw = np.random.default_rng(seed)
    a = draw.random((6, 15))
    b = draw.random(6) * 5
    x = packing.nonnegative_least_squares(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gradient <= 1e-6).all()
    assert np.abs(gradient[x > 0]).max(initial=0) < 1e-6


def test_solution_of_an_exact_histogram():
    columns = packing._columns()
    repeats = np.zeros(columns.shape[1])
    repeats[[3, 40, 100]] = [5, 7, 2]
    found = packing.nonnegative_least_squares(columns, columns @ repeats)
    assert np.allclose(columns @ found, columns @ repeats, atol=1e-6)


def test_combinations_fill_a_window():
    found = packing.combinations()
    assert len(set(found)) == len(found)
    assert all(sum(c) == packing.CLASSES and len(c) <= packing.MOST_PARTS for c in found)


@pytest.mark.parametrize("lengths", [[], [1], [2047], [1024, 1024], [1500] * 9, [3, 700, 2047, 1, 64]])
def test_blocks_keep_every_id(lengths):
    pieces = [packing.Piece(n, np.arange(size), 0, size) for n, size in enumerate(lengths)]
    full, rest = packing.pack_block(pieces)
    assert all(sum(map(len, window)) == 2048 for window in full)
    assert sum(map(len, rest)) < 2048
    last = packing.powers_of_two(rest)
    spread = [(p.doc, k) for window in [*full, *last] for p in window for k in range(p.start, p.stop)]
    assert sorted(spread) == [(n, k) for n, size in enumerate(lengths) for k in range(size)]
