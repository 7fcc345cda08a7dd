"""Byte-level byte-pair encoding by dynamic programming over prefixes, and its inverse.

In a byte-pair encoding every prefix of a word has exactly one last token: the one that
ends there and is compatible with the last token of the prefix before it. An automaton
over the vocabulary gives the tokens that end at each byte; two tokens are compatible if
merging the bytes of both leads to just these two. Back-pointers then give the ids.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm import words as W
from tillmart.llm.common import slices
from tillmart.llm.packing import byte_signs

SCHEMA = "doc_id long, ids array<int>, decoded string"

# Remembered pairs of tokens; the memory starts anew beyond that.
MOST_PAIRS = 2_000_000


class BytePairs:
    """Vocabulary and merges of a byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        byte_of = {sign: byte for byte, sign in byte_signs().items()}
        self.bytes_of = {
            number: bytes(byte_of[sign] for sign in token) for token, number in model["vocab"].items()
        }
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocabulary = model["vocab"]
        self.merged = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b])
            for rank, (a, b) in enumerate(merges)
        }
        self.byte_ids = [vocabulary[byte_signs()[byte]] for byte in range(256)]
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for number, token in self.bytes_of.items():
            self.automaton.add_word(token.decode("latin-1"), (number, len(token)))
        self.automaton.make_automaton()
        longest = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, longest)) + ")").split
        self._tables()
        self.memo = W.Memo(self.word_ids)

    def _tables(self) -> None:
        shown = dict(self.bytes_of) | {n: s.encode() for s, n in self.special.items()}
        tokens = [shown.get(number, b"") for number in range(max(shown) + 1)]
        self.counts = np.array([len(token) for token in tokens], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a few bytes by merging the pair of lowest rank, the leftmost first."""
        ids = [self.byte_ids[byte] for byte in data]
        while len(ids) > 1:
            found = [(self.merged[p][0], at) for at, p in enumerate(zip(ids, ids[1:])) if p in self.merged]
            if not found:
                break
            _, at = min(found)
            ids[at : at + 2] = [self.merged[ids[at], ids[at + 1]][1]]
        return ids

    def compatible(self, before: int, after: int) -> bool:
        """Whether `after` can follow `before`; -1 stands for the start of a word."""
        known = self.pairs.get((before, after))
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            if before < 0:
                known = self.merge(self.bytes_of[after]) == [after]
            else:
                known = self.merge(self.bytes_of[before] + self.bytes_of[after]) == [before, after]
            self.pairs[before, after] = known
        return known

    def word_ids(self, word: str) -> list[int]:
        data = word.encode().decode("latin-1")
        last, begin = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        done = 0
        for end, (number, length) in self.automaton.iter(data):
            end += 1
            if end == done:
                continue
            if self.compatible(last[end - length], number):
                last[end], begin[end], done = number, end - length, end
        ids = []
        end = len(data)
        while end:
            ids.append(last[end])
            end = begin[end]
        return ids[::-1]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; the strings of special tokens give their ids."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        owner, plain = [], []
        for number, text in enumerate(texts):
            for part in self.split_special(text) if any(s in text for s in self.special) else [text]:
                owner.append(number)
                plain.append(part)
        for numbers, held in W.pieces(plain):
            joined = W.Texts([text if text not in self.special else "" for text in held])
            starts, ends = W.spaced_words(joined)
            rows = self.memo.rows_of(joined, starts, ends)
            ids, counts = self.memo.values(rows), self.memo.counts(rows)
            upto = np.concatenate([[0], np.cumsum(counts)])
            bounds = upto[np.searchsorted(starts, joined.first)]
            for k, (number, text) in enumerate(zip(numbers, held)):
                special = self.special.get(text)
                got = ids[bounds[k] : bounds[k + 1]]
                parts[owner[number]].append(got if special is None else np.array([special], np.int32))
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, special tokens included."""
        data = W.gathered(self.flat, self.first[ids], self.counts[ids])
        return data.tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(path)


def _task(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pairs = byte_pairs(path)
    for batch in slices(batches):
        texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
        for numbers, _ in _runs(texts):
            held = [texts[n] for n in numbers]
            ids = pairs.encode(held)
            decoded = [pairs.decode(one) for one in ids]
            bounds = np.cumsum([0] + [len(one) for one in ids]).astype(np.int32)
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(numbers)),
                    pa.ListArray.from_arrays(pa.array(bounds), flat),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )


def _runs(texts: list[str]) -> Iterator[tuple[list[int], int]]:
    """Numbers of texts that follow each other and have some million characters."""
    numbers: list[int] = []
    chars = 0
    for number, text in enumerate(texts):
        numbers.append(number)
        chars += len(text)
        if chars >= 4 * W.PIECE_CHARS:
            yield numbers, chars
            numbers, chars = [], 0
    if numbers:
        yield numbers, chars


def encode_decode(
    documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The ids of every whole text, and the text that the ids give again.

    Rows go through one by one: repeated rows and null ids come out as they came in. A null
    text counts as empty; an empty text has no ids and decodes to an empty text. A very long
    text is split between words on its way, which does not change its ids. Other columns are
    not read. An empty table gives no rows.
    """
    chosen = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return chosen.mapInArrow(functools.partial(_task, path=path), SCHEMA)
