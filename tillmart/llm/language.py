"""Language identification: known words first, shorter and shorter letter groups after.

A model holds, for each language, log frequencies of whole words and of letter groups of
one to `LONGEST` signs (with word ends marked). A word the model knows is scored by its
frequencies; any other word is cut from left to right into the longest known groups, each
of which is scored, with a discount for each level that is given up.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm import words as W
from tillmart.llm.common import most_frequent_by, passing_tables, slices, written

UNDETERMINED = "und"

# Bounds of the model: labelled rows it is learned from, words and letter groups it keeps, of
# which each language has an equal share.
TRAINING_ROWS = 20_000
MOST_WORDS = 150_000
MOST_GROUPS = 60_000

LONGEST = 5
BACKOFF = 0.4
EDGE = "\x02"

# What a worker holds at once: different words it has looked up, and characters it works on.
MEMO_WORDS = 100_000
PIECE_CHARS = 250_000

# The evidence of a text counts as that of so many words at most, so that scores of long
# texts don't all become one.
EVIDENCE_WORDS = 40


@dataclass
class HashedWords:
    """Numbers of words by their 64-bit hashes, a tenth of the size of a dictionary."""

    hashes: np.ndarray
    numbers: np.ndarray

    @classmethod
    def of(cls, words: dict[str, int]) -> HashedWords:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        order = np.argsort(hashes)
        return cls(hashes[order], np.fromiter(words.values(), np.int32, len(words))[order])

    def __len__(self) -> int:
        return len(self.hashes)

    def get(self, word: str) -> int | None:
        wanted = np.uint64(xxhash.xxh3_64_intdigest(word))
        at = int(np.searchsorted(self.hashes, wanted))
        return int(self.numbers[at]) if at < len(self.hashes) and self.hashes[at] == wanted else None


@dataclass
class Model:
    """Log frequencies of words and groups, one column per language."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    groups: dict[str, int]
    word_scores: np.ndarray
    group_scores: np.ndarray
    unseen: np.ndarray
    # For each language, how much of new text its words are expected to cover.
    shares: np.ndarray | None = None
    memo: W.Memo = field(default=None, repr=False)
    all_scores: np.ndarray = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        """What is sent to tasks: words by their hashes, all scores once, and no memory, which
        each worker has of its own."""
        return vars(self) | {
            "memo": None, "all_scores": self.table(), "word_scores": None, "group_scores": None,
            "words": HashedWords.of(self.words) if isinstance(self.words, dict) else self.words,
        }

    def rows_of_word(self, word: str) -> list[int]:
        """The rows of scores that a word adds: its own, or those of its groups."""
        known = self.words.get(word)
        if known is not None:
            return [known]
        base, levels = len(self.words), LONGEST
        rows, text, at = [], f"{EDGE}{word}{EDGE}", 0
        while at < len(text):
            for size in range(min(levels, len(text) - at), 0, -1):
                group = self.groups.get(text[at : at + size])
                if group is not None:
                    break
            rows.append(base + (len(self.groups) if group is None else group))
            at += size
        return rows

    def table(self) -> np.ndarray:
        if self.word_scores is None:
            return self.all_scores
        return np.vstack([self.word_scores, self.group_scores, self.unseen[None, :]])


def learn(
    documents: DataFrame,
    rows: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    training_rows: int = TRAINING_ROWS,
) -> Model:
    """A model from labelled rows, `rows` telling which may be used.

    About `training_rows` of them are used, those with small hashes of their id, so the sample
    does not depend on partitions. Words and letter groups are counted by Spark; what
    comes to the driver is bounded by MOST_WORDS and MOST_GROUPS, of which every language of the
    sample has an equal share, so that a rare one keeps its words beside a frequent one. Rows
    without a label or text teach nothing. Without any, the model has no language.
    """
    chosen = documents if rows is None else documents.filter(rows)
    labelled = chosen.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(id_col).alias("order"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    with passing_tables(documents.sparkSession):
        return _learned(labelled, training_rows)


def _learned(labelled: DataFrame, training_rows: int) -> Model:
    share = min(1.0, training_rows / max(1, labelled.count()))
    last = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    sample = labelled.filter(F.col("order") <= last)
    counts = (
        sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
        .filter("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = written(counts, "language-words")
    words = _kept(counts, MOST_WORDS)
    marked = F.concat(F.lit(EDGE), F.col("word"), F.lit(EDGE))
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length(marked)))
    groups = F.flatten(
        F.transform(
            sizes,
            lambda n: F.transform(
                F.sequence(F.lit(1), F.length(marked) - n + 1),
                lambda at: F.substring(marked, at, n),
            ),
        )
    )
    by_group = (
        counts.select("lang", "n", F.explode(groups).alias("word"))
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    top_groups = _kept(written(by_group, "language-groups"), MOST_GROUPS)
    languages = sorted(row["lang"] for row in sample.select("lang").distinct().collect())
    totals = {row["lang"]: row["n"] for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    return _fitted(languages, words.toArrow(), top_groups.toArrow(), totals)


def _kept(counts: DataFrame, limit: int) -> DataFrame:
    """lang, word and n of all words that are among the most frequent of a language."""
    chosen = most_frequent_by(counts, "lang", "n", limit).select("word").distinct()
    return counts.join(chosen, "word", "left_semi").select("lang", "word", "n").orderBy("word", "lang")


def _fitted(
    languages: list[str], words: pa.Table, groups: pa.Table, n_by_lang: dict[str, int]
) -> Model:
    def counted(rows: pa.Table) -> tuple[dict[str, int], np.ndarray]:
        """The number of each word, and its counts by language."""
        coded = rows["word"].combine_chunks().dictionary_encode()
        langs = pc.index_in(rows["lang"].combine_chunks(), pa.array(languages, pa.string()))
        table = np.zeros((len(coded.dictionary), len(languages)))
        place = coded.indices.to_numpy(zero_copy_only=False)
        table[place, langs.to_numpy(zero_copy_only=False)] = rows["n"].to_numpy()
        return {word: number for number, word in enumerate(coded.dictionary.to_pylist())}, table

    word_rows, word_counts = counted(words)
    group_rows, group_counts = counted(groups)
    totals = word_counts.sum(axis=0)
    seen = np.maximum(totals, 1)
    word_scores = np.log((word_counts + 0.1) / (seen + 0.1 * max(1, len(word_rows))))
    sizes = np.array([len(group) for group in group_rows], int)
    group_scores = np.zeros_like(group_counts)
    for size in range(1, LONGEST + 1):
        at = sizes == size
        of_size = np.maximum(group_counts[at].sum(axis=0), 1)
        level = (LONGEST - size + 1) * np.log(BACKOFF)
        group_scores[at] = np.log((group_counts[at] + 0.1) / (of_size + 0.1 * max(1, at.sum())))
        group_scores[at] += level
    unseen = np.full(len(languages), (LONGEST + 1) * np.log(BACKOFF) - 12.0)
    share = totals / max(1.0, totals.sum())
    prior = np.log(np.maximum(share, 1e-12)) * 1e-3
    # As many words of new text are unknown as were seen once only, or are not kept.
    often = np.where(word_counts >= 2, word_counts, 0).sum(axis=0)
    shares = often / np.array([max(1, n_by_lang.get(name, 0)) for name in languages], float)
    return Model(languages, prior, word_rows, group_rows, word_scores, group_scores, unseen, shares)


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and number of words of each whole text."""
    return judged(model, texts)[:3]


def judged(
    model: Model, texts: list[str | None]
) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, number of words and doubt of each whole text.

    The doubt is how surely the text is in none of the languages: minus the log of a bound
    (Chernoff's) for the chance that so few of its words were known if each were known with half
    the share expected of the predicted language. It is 0 if at least that many are known.
    """
    if model.memo is None:
        model.memo = W.Memo(model.rows_of_word, limit=MEMO_WORDS)
        model.all_scores = model.table()
    count = len(model.languages)
    sums = np.zeros((len(texts), count))
    n_words = np.zeros(len(texts), np.int64)
    n_known = np.zeros(len(texts), np.int64)
    has_letter = np.zeros(len(texts), bool)
    for numbers, held in W.pieces([(text or "").lower() for text in texts], PIECE_CHARS):
        joined = W.Texts(held)
        starts, ends = W.letter_words(joined)
        owners = np.array(numbers)[joined.text_of(starts)]
        np.add.at(n_words, owners, 1)
        has_letter[owners] = True
        if not count or not len(starts):
            continue
        rows = model.memo.rows_of(joined, starts, ends)
        scored, counts = model.memo.values(rows), model.memo.counts(rows)
        owners = np.repeat(owners, counts)
        n_known += np.bincount(owners[scored < len(model.words)], minlength=len(texts))
        for lang in range(count):
            sums[:, lang] += np.bincount(owners, model.all_scores[scored, lang], len(texts))
    if not count:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), n_words, np.zeros(len(texts))
    scaled = sums * np.minimum(1.0, EVIDENCE_WORDS / np.maximum(n_words, 1))[:, None] + model.prior
    scaled -= scaled.max(axis=1, keepdims=True)
    chances = np.exp(scaled)
    chances /= chances.sum(axis=1, keepdims=True)
    best = chances.argmax(axis=1)
    names = [model.languages[b] if h else UNDETERMINED for b, h in zip(best, has_letter)]
    shares = np.zeros(count) if model.shares is None else model.shares
    doubt = _doubt(n_words, n_known, shares[best] / 2)
    return names, np.where(has_letter, chances.max(axis=1), 0.0), n_words, doubt


def _doubt(n_words: np.ndarray, n_known: np.ndarray, expected: np.ndarray) -> np.ndarray:
    known = n_known / np.maximum(n_words, 1)
    # Below any share, however small, no logarithm is of zero.
    share, rest = np.maximum(known, 1e-300), np.maximum(1 - known, 1e-300)
    fewer = known * np.log(share / np.maximum(expected, 1e-300))
    others = (1 - known) * np.log(rest / (1 - expected))
    return np.where(known < expected, n_words * (fewer + others), 0.0)


def _task(batches: Iterable[pa.RecordBatch], shared, text_at: int) -> Iterator[pa.RecordBatch]:
    """The rows as they are, with the prediction for the text at the end."""
    model = shared.value
    for batch in slices(batches):
        names, scores, n_words, doubt = judged(model, batch.column(text_at).to_pylist())
        added = [pa.array(names, pa.string()), pa.array(scores), pa.array(n_words), pa.array(doubt)]
        columns = [*batch.columns, *added]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *ADDED])


ADDED = ["lang_pred", "score", "n_words", "doubt"]


def identify(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns, with lang_pred, score (0 to 1), n_words and doubt of the whole text.

    The doubt, 0 or more, says how surely the text is in none of the languages (see `judged`); the
    prediction does not depend on it.

    Rows are scored one by one: repeated rows, null ids and ties come out as they came in, a
    tie going to the language more frequent in the training rows, then to the first by name. A
    text that is null or has no letter is `und` with score 0; so is every text if the model has
    no language. Columns with the names of the four added are replaced; an empty table gives
    no rows. Texts must be strings.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    given = documents.drop(*ADDED)
    schema = T.StructType(
        [
            *given.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("doubt", T.DoubleType()),
        ]
    )
    task = functools.partial(_task, shared=shared, text_at=given.columns.index(text_col))
    return given.mapInArrow(task, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of learning: crc32 of its id as text, mod 4, is 2."""
    digest = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.pmod(digest, F.lit(4)) == 2
