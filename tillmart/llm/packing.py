"""Pack documents of token ids into windows, with repeat counts from least squares.

Every task packs its own documents, block by block, so no row is shuffled and memory is
bounded by a block. A document is chopped into full windows and one rest. The rests of a
block are counted in classes of length; all shallow combinations of classes that fill a
window are columns of a non-negative least-squares problem whose solution says how often
each is used. What rounding leaves is packed greedily, cutting pieces to fill windows to
the end. Windows not yet full are carried to the next block; what a task has left at the
end becomes windows of powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm import words as W
from tillmart.llm.common import slices

WINDOW = 2048
END_ID = 1
CLASSES = 32
MOST_PARTS = 4
BLOCK_DOCUMENTS = 4096
BLOCK_IDS = 4_000_000

COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
SCHEMA = ", ".join(f"{name} {'binary' if name == 'ids' else 'long'}" for name in COLUMNS)


# --- token ids -------------------------------------------------------------------


class WordIds:
    """Ids of whole texts by a word-level tokenizer of the tokenizers library.

    The library's model gives the ids of each different word; words are found by `words`.
    Texts the library would first change in ways beyond lower-casing (special tokens,
    composed characters, characters newer than Python's tables) go through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.signs = byte_signs()
        model = self.tokenizer.model
        self.memo = W.Memo(lambda word: [t.id for t in model.tokenize(self._mapped(word))])

    def _mapped(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.signs)

    def _plain(self, text: str) -> bool:
        return text.isascii() or (
            unicodedata.is_normalized("NFC", text)
            and "Σ" not in text
            and "İ" not in text
            and not _has_new(text)
        )

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens added."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        simple = []
        for number, text in enumerate(texts):
            if any(s in text for s in self.specials) or not self._plain(text):
                whole = self.tokenizer.encode(text, add_special_tokens=False).ids
                parts[number].append(np.array(whole, np.int32))
                simple.append("")
            else:
                simple.append(text.lower())
        for numbers, held in W.pieces(simple):
            joined = W.Texts(held)
            starts, ends = W.words(joined)
            rows = self.memo.rows_of(joined, starts, ends)
            ids, counts = self.memo.values(rows), self.memo.counts(rows)
            upto = np.concatenate([[0], np.cumsum(counts)])
            bounds = upto[np.searchsorted(starts, joined.first)]
            for k, number in enumerate(numbers):
                parts[number].append(ids[bounds[k] : bounds[k + 1]])
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]


@functools.cache
def byte_signs() -> dict[int, str]:
    """The printable sign that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


@functools.cache
def _new_characters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def _has_new(text: str) -> bool:
    return bool(_new_characters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any())


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


# --- combinations and their repeat counts ------------------------------------------


@functools.cache
def combinations(classes: int = CLASSES, parts: int = MOST_PARTS) -> list[tuple[int, ...]]:
    """All falling tuples of at most `parts` classes that sum to `classes`."""

    def tuples(rest: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if rest == 0:
            yield ()
        elif left:
            for part in range(min(rest, most), 0, -1):
                for more in tuples(rest - part, part, left - 1):
                    yield (part, *more)

    return list(tuples(classes, classes, parts))


@functools.cache
def _columns() -> np.ndarray:
    matrix = np.zeros((CLASSES, len(combinations())))
    for column, combination in enumerate(combinations()):
        for part in combination:
            matrix[part - 1, column] += 1
    return matrix


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the smallest |a x - b|, by the active-set method of Lawson and Hanson."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    useless = np.zeros(a.shape[1], bool)
    limit = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(10 * a.shape[1]):
        gradient = a.T @ (b - a @ x)
        gradient[active | useless] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= limit:
            break
        before = x.copy()
        active[best] = True
        while True:
            trial = np.zeros_like(x)
            if active.any():
                trial[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (trial <= 1e-12)
            if not low.any():
                break
            steps = x[low] / np.maximum(x[low] - trial[low], 1e-300)
            x = x + steps.min() * (trial - x)
            active &= x > 1e-12
            x[~active] = 0
        x = trial
        if np.allclose(x, before, rtol=0, atol=1e-12):
            useless[best] = True
        else:
            useless[:] = False
    return x


# --- one task ----------------------------------------------------------------------


class Piece:
    """`ids[start:stop]` of one document."""

    __slots__ = ("doc", "ids", "start", "stop")

    def __init__(self, doc: int | None, ids: np.ndarray, start: int, stop: int):
        self.doc, self.ids, self.start, self.stop = doc, ids, start, stop

    def __len__(self) -> int:
        return self.stop - self.start

    def cut(self, length: int) -> tuple[Piece, Piece]:
        middle = self.start + length
        return (
            Piece(self.doc, self.ids, self.start, middle),
            Piece(self.doc, self.ids, middle, self.stop),
        )


def pack_block(rests: list[Piece]) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows made of pieces shorter than a window, and the pieces left over."""
    width = WINDOW // CLASSES
    by_class: list[list[Piece]] = [[] for _ in range(CLASSES + 1)]
    for piece in rests:
        by_class[-(-len(piece) // width)].append(piece)
    histogram = np.array([len(pieces) for pieces in by_class[1:]], float)
    repeats = np.floor(nonnegative_least_squares(_columns(), histogram) + 1e-9).astype(int)
    open_windows: list[list[Piece]] = []
    for column in np.argsort(-repeats, kind="stable"):
        parts = combinations()[column]
        for _ in range(repeats[column]):
            if any(len(by_class[p]) < parts.count(p) for p in parts):
                break
            open_windows.append([by_class[p].pop() for p in parts])
    pool = deque(piece for pieces in reversed(by_class) for piece in pieces)
    full: list[list[Piece]] = []
    while open_windows or pool:
        window = open_windows.pop() if open_windows else []
        room = WINDOW - sum(map(len, window))
        while room:
            if not pool:
                if not open_windows:
                    return full, window
                pool.extend(open_windows.pop(0))
            piece = pool.popleft()
            if len(piece) > room:
                piece, rest = piece.cut(room)
                pool.appendleft(rest)
            window.append(piece)
            room -= len(piece)
        full.append(window)
    return full, []


def powers_of_two(rests: list[Piece]) -> list[list[Piece]]:
    """The pieces in windows of falling powers of two, without padding."""
    pool, windows = deque(rests), []
    left = sum(map(len, rests))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        window: list[Piece] = []
        while room:
            piece = pool.popleft()
            if len(piece) > room:
                piece, rest = piece.cut(room)
                pool.appendleft(rest)
            window.append(piece)
            room -= len(piece)
        windows.append(window)
    return windows


def _blocks(
    batches: Iterable[pa.RecordBatch], path: str
) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    block: list[tuple[int | None, np.ndarray]] = []
    size = 0
    for batch in slices(batches):
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for doc, ids in zip(batch.column(0).to_pylist(), word_ids(path).ids(texts)):
            block.append((doc, np.concatenate([ids, [END_ID]]).astype("<u4")))
            size += len(ids) + 1
            if len(block) >= BLOCK_DOCUMENTS or size >= BLOCK_IDS:
                yield block
                block, size = [], 0
    yield block


def _rows(windows: list[list[Piece]], first: int) -> pa.RecordBatch:
    rows = []
    for number, window in enumerate(windows):
        offset = 0
        for p in window:
            ids = p.ids[p.start : p.stop].tobytes()
            rows.append((p.doc, p.start, len(p), ids, len(p.ids), first + number, offset))
            offset += len(p)
    columns = list(zip(*rows)) or [()] * len(COLUMNS)
    kinds = [pa.binary() if name == "ids" else pa.int64() for name in COLUMNS]
    arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, COLUMNS)


def _pack_task(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    sequence = TaskContext.get().partitionId() << 33
    rests: list[Piece] = []
    for block in _blocks(batches, path):
        windows = []
        for doc, ids in block:
            whole = len(ids) // WINDOW * WINDOW
            windows += [[Piece(doc, ids, s, s + WINDOW)] for s in range(0, whole, WINDOW)]
            if whole < len(ids):
                rests.append(Piece(doc, ids, whole, len(ids)))
        full, rests = pack_block(rests)
        windows += full
        for low in range(0, len(windows), 2000):
            yield _rows(windows[low : low + 2000], sequence + low)
        sequence += len(windows)
    yield _rows(powers_of_two(rests), sequence)


def pack(
    documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids.

    A document is its text's ids and one END_ID; a null or empty text is that id alone. A
    repeated row is packed again under its own ids. A null id stays null. Other columns are
    not read. `ids` holds little-endian unsigned 32-bit ids, `start` counts the document's
    ids before the piece, `offset` the window's. All windows hold 2048 ids but for at most
    eleven in each task, whose lengths are powers of two. An empty table gives no rows.
    """
    chosen = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return chosen.mapInArrow(functools.partial(_pack_task, path=tokenizer_path), SCHEMA)
