"""Byte-pair encoding against the tokenizers library."""

from __future__ import annotations

import functools

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillmart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "aa", "the", " ", "  ", "\n", "'s", "'LL", "1", "23", "é", "中", "🙂", "--", "<|endoftext|>",
          "ing", "Tion", "\x1c", "́", "="]


@functools.cache
def _library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
def test_ids_and_round_trip(text):
    pairs = bpe.byte_pairs(PATH)
    ids = pairs.encode([text])[0]
    assert ids.tolist() == _library().encode(text, add_special_tokens=False).ids
    assert pairs.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    pairs = bpe.byte_pairs(PATH)
    ids = pairs.encode([text])[0]
    assert ids.tolist() == _library().encode(text, add_special_tokens=False).ids
    assert pairs.decode(ids) == text


def test_parts_of_a_character_decode_as_in_the_library():
    pairs = bpe.byte_pairs(PATH)
    ids = pairs.encode(["🙂 é"])[0]
    for size in range(len(ids) + 1):
        assert pairs.decode(ids[:size]) == _library().decode(ids[:size].tolist(), skip_special_tokens=False)


def test_every_prefix_has_one_last_token():
    pairs = bpe.byte_pairs(PATH)
    for word in ("thethethe", "aaaaaaaaa", " internationalization"):
        for end in range(1, len(word) + 1):
            ids = pairs.word_ids(word[:end])
            assert ids == pairs.merge(word[:end].encode())


def test_table_with_edges(spark):
    long = "ab cd " * 400_000
    rows = [(1, "the cat"), (1, "the cat"), (2, None), (3, ""), (None, "x"), (4, long)]
    given = spark.createDataFrame([(*r, 7, "y") for r in rows], "doc_id long, text string, ids int, decoded string")
    found = bpe.encode_decode(given, PATH).collect()
    assert sorted(map(str, [r.doc_id for r in found])) == ["1", "1", "2", "3", "4", "None"]
    for row in found:
        text = {1: "the cat", 2: "", 3: "", None: "x", 4: long}[row.doc_id]
        assert row.decoded == text
        assert row.ids == _library().encode(text, add_special_tokens=False).ids
    assert bpe.encode_decode(given.limit(0), PATH).count() == 0
