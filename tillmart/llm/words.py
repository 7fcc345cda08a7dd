"""Word boundaries and 64-bit word hashes over many texts at once, in numpy.

Texts are joined into one array of code points; runs of one character class give the
words, and a prefix sum of weighted code points gives the hash of any span.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

# The white space of the Unicode standard.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Texts are handled in pieces of about this many characters.
PIECE_CHARS = 1_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def character_classes() -> np.ndarray:
    """The class of each code point, with letters and numbers as the tokenizers library has them.

    Code points newer than Python's tables are asked of the library.
    """
    import regex
    from tokenizers import pre_tokenizers

    kinds = np.zeros(0x110000, np.uint8)
    fresh = []
    for code in range(0x110000):
        category = unicodedata.category(chr(code))
        if category[0] == "L":
            kinds[code] = LETTER
        elif category[0] == "N":
            kinds[code] = NUMBER
        elif category == "Cn":
            fresh.append(chr(code))
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for char in regex.findall(r"[\p{L}\p{N}]", "".join(fresh)):
        for kind, like in ((LETTER, "a"), (NUMBER, "1")):
            if len(split(like + char)) == 1:
                kinds[ord(char)] = kind
    kinds[WHITE_SPACE] = SPACE
    return kinds


@functools.cache
def _weights() -> np.ndarray:
    return mixed((np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * _STEP)


@functools.cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for 2**bits positions."""
    inverse = pow(_BASE, -1, 1 << 64)
    ones = np.ones(1 << bits, np.uint64)
    with np.errstate(over="ignore"):
        up, down = ones * np.uint64(_BASE), ones * np.uint64(inverse)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Texts:
    """Joined texts as code points; `first` holds where each text begins, and the end."""

    def __init__(self, texts: list[str]):
        self.joined = "".join(texts)
        self.points = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        self.first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(text) for text in texts], out=self.first[1:])

    def is_first(self) -> np.ndarray:
        marks = np.zeros(len(self.points) + 1, bool)
        marks[self.first] = True
        return marks

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The number of the text that holds each position."""
        return np.searchsorted(self.first, positions, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One 64-bit hash for each span, the same for equal spans anywhere."""
        size = max(len(self.points), 1)
        up, down = _powers(max(20, (size - 1).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.zeros(size + 1, np.uint64)
            weighted = _weights()[self.points] * up[: len(self.points)]
            np.cumsum(weighted, out=sums[1 : len(self.points) + 1])
            spans = (sums[ends] - sums[starts]) * down[starts]
            return mixed(spans + (ends - starts).astype(np.uint64) * _STEP)

    def span(self, start: int, end: int) -> str:
        return self.joined[start:end]


def _contractions(texts: Texts, kinds: np.ndarray, start: np.ndarray, edge: np.ndarray) -> None:
    """Join an apostrophe that begins a word with the ending after it, as 's or 'll."""
    points, size = texts.points, len(texts.points)
    at = np.flatnonzero((points == 39) & start[:size])
    at = at[(at + 1 < size)]
    at = at[start[at + 1] & ~edge[at + 1] & (kinds[at + 1] == LETTER)]
    if not len(at):
        return
    one = points[at + 1]
    inside = (at + 2 < size) & ~edge[np.minimum(at + 2, size)]
    two = np.where(inside, points[np.minimum(at + 2, size - 1)], 0)
    letters = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    for a, b in ("re", "ve", "ll"):
        letters[(one == ord(a)) & (two == ord(b))] = 2
    at, letters = at[letters > 0], letters[letters > 0]
    start[at + 1] = False
    after = at + 1 + letters
    inside = (after < size) & ~edge[np.minimum(after, size)]
    after = after[inside]
    start[after[kinds[after] == LETTER]] = True


def words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters, single numbers and runs of other signs."""
    kinds, edge = character_classes()[texts.points], texts.is_first()
    start = edge.copy()
    start[1:-1] |= kinds[1:] != kinds[:-1]
    start[:-1] |= kinds == NUMBER
    start[-1] = True
    _contractions(texts, kinds, start, edge)
    bounds = np.flatnonzero(start)
    keep = kinds[bounds[:-1]] != SPACE
    return bounds[:-1][keep], bounds[1:][keep]


def spaced_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """As `words`, but a run of numbers is one word, a blank before a word belongs to it,
    and other white space gives words of its own; together they cover the texts."""
    points, size = texts.points, len(texts.points)
    kinds, edge = character_classes()[points], texts.is_first()
    start = edge.copy()
    start[1:-1] |= kinds[1:] != kinds[:-1]
    start[-1] = True
    run = np.flatnonzero(start)
    first, after = run[:-1], run[1:]
    inner = (kinds[first] == SPACE) & ~edge[after] if size else np.zeros(0, bool)
    first, after = first[inner], after[inner]
    blank = points[after - 1] == 32
    start[after[blank]] = False
    start[after - 1] |= after - first > 1
    start[after[blank] - 1] = True
    _contractions(texts, kinds, start, edge)
    bounds = np.flatnonzero(start)
    return bounds[:-1], bounds[1:]


def letter_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters."""
    kinds, start = character_classes()[texts.points], texts.is_first()
    start[1:-1] |= kinds[1:] != kinds[:-1]
    start[-1] = True
    bounds = np.flatnonzero(start)
    keep = kinds[bounds[:-1]] == LETTER
    return bounds[:-1][keep], bounds[1:][keep]


def pieces(texts: Iterable[str], limit: int = PIECE_CHARS) -> Iterator[tuple[list[int], list[str]]]:
    """Lists of text numbers and texts of together about `limit` characters.

    A longer text comes in parts, each a list of its own, cut before a blank between two
    characters that are no white space, where a word ends in every way of splitting here.
    """
    numbers: list[int] = []
    held: list[str] = []
    chars = 0
    for number, text in enumerate(texts):
        if held and chars + len(text) > limit:
            yield numbers, held
            numbers, held, chars = [], [], 0
        while len(text) > limit:
            cut = _cut(text, limit)
            if cut == len(text):
                break
            yield [number], [text[:cut]]
            text = text[cut:]
        numbers.append(number)
        held.append(text)
        chars += len(text)
    if held:
        yield numbers, held


def _cut(text: str, limit: int) -> int:
    at = text.find(" ", limit)
    while 0 < at < len(text) - 1:
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
        at = text.find(" ", at + 1)
    return len(text)


class Memo:
    """Integer lists by word hash, worked out once for each different word.

    `work` gives the integers of a word. The memo is emptied when it holds `limit` words.
    """

    def __init__(self, work: Callable[[str], list[int]], limit: int = 400_000):
        self.work, self.limit = work, limit
        self.clear()

    def clear(self) -> None:
        self.rows: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _add(self, key: int, values: list[int]) -> None:
        row, size = len(self.rows), self.used + len(values)
        if size > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(size, len(self.flat)), np.int32)])
        if row + 1 >= len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.flat[self.used : size] = values
        self.rows[key] = row
        self.used = size
        self.first[row + 1] = size

    def rows_of(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The memo's row of each span. Rows hold until the next call."""
        codes, keys = pd.factorize(texts.hashes(starts, ends))
        if len(self.rows) + len(keys) > self.limit:
            self.clear()
        known = np.fromiter(
            map(functools.partial(_get, self.rows), keys.tolist()), np.int64, len(keys)
        )
        missing = np.flatnonzero(known < 0)
        if len(missing):
            at = np.zeros(len(keys), np.int64)
            at[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            for code in missing.tolist():
                span = texts.span(int(starts[at[code]]), int(ends[at[code]]))
                known[code] = len(self.rows)
                self._add(int(keys[code]), self.work(span))
        return known[codes]

    def counts(self, rows: np.ndarray) -> np.ndarray:
        return self.first[rows + 1] - self.first[rows]

    def values(self, rows: np.ndarray) -> np.ndarray:
        """All integers of the rows, one row after another."""
        return gathered(self.flat, self.first[rows], self.counts(rows))


def _get(rows: dict[int, int], key: int) -> int:
    return rows.get(key, -1)


def gathered(flat: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """flat[first[0] : first[0] + counts[0]], then flat[first[1] : ...], and so on."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return flat[np.repeat(first - before, counts) + np.arange(total)]
