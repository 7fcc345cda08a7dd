"""Masked pseudo-likelihood of documents under a bidirectional window network.

A small network reads the words on both sides of a place, WINDOW on each side, and predicts
the word at the place: P(word) = P(class | words around) * P(word | class, words around). The
most frequent words are classes of their own, all others share classes by hash. Inside a class
a Huffman tree over the counts leads to the word, so frequent words come through few forks; the
network moves the odds at the FORK_ROWS heaviest forks, which counts of the whole corpus give, by
what it sees around. Below them, and for words that no task holds, the counts alone tell words
apart. A document's score is the sum of the log probabilities of all its words.

Counts of words come from all documents. The network is trained in numpy on shards of the
documents, to which these are dealt by hash, however they were stored; each shard starts from
the weights of the round before, and a round's weights are averages over the shards, weighted by
the words they saw: what is gathered grows with the input. Every word of every document is
predicted once in training.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm import words as W
from tillmart.llm.common import most_frequent, passing_tables, written

WINDOW = 2
HIDDEN = 16
OWN_CLASSES = 48
SHARED_CLASSES = 16
CLASSES = OWN_CLASSES + SHARED_CLASSES
# Forks with weights, the heaviest of all trees.
FORK_ROWS = 32_768
INPUTS = 4096
ROUNDS = 2
# Words that a shard has, about, in each round; the number of shards grows with the corpus.
SHARD_WORDS = 2_500_000
# Every STRIDE-th window of every document is a training example; one leaves none out.
STRIDE = 1
RATE = 0.2
EXAMPLES = 2048
SEED = 7
# Products of so many rows with HIDDEN x CLASSES weights are too small for BLAS to start threads for
# them, which would wait busily beside the other tasks of the executor.
BLAS_ROWS = 128

COLUMNS = ["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"]
SCORED = "doc_id long, n_words long, log_likelihood double, rest array<long>"


# --- the words of the corpus -------------------------------------------------------


@dataclass
class Vocabulary:
    """Counts of the corpus: frequent words by hash, the others in sums by class.

    Where a class has words that are not held here, their log P(word | class) is NaN; the
    table of all counts tells it by `totals`, the counts of the classes.
    """

    hashes: np.ndarray
    inputs: np.ndarray
    classes: np.ndarray
    log_in_class: np.ndarray
    rest_log_in_class: np.ndarray
    log_classes: np.ndarray
    paths: Paths
    totals: np.ndarray

    def look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input row, class and log P(word | class) of each word hash."""
        return self.known(found)[:3]

    def known(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As `look_up`, and the leaf of each word. Words that are not held lie in one leaf of
        their class."""
        codes, keys = pd.factorize(found)
        at = np.searchsorted(self.hashes, keys)
        at = np.minimum(at, max(0, len(self.hashes) - 1))
        known = self.hashes[at] == keys if len(self.hashes) else np.zeros(len(keys), bool)
        classes = _shared_class(keys)
        leaves = np.where(known, at, len(self.hashes) + classes - OWN_CLASSES)
        inputs = _shared_input(keys)
        logs = self.rest_log_in_class[classes]
        if known.any():
            classes[known] = self.classes[at[known]]
            inputs[known] = self.inputs[at[known]]
            logs[known] = self.log_in_class[at[known]]
        return inputs[codes], classes[codes], logs[codes], leaves[codes]


@dataclass
class Paths:
    """The weighted forks from the root to each leaf, and the odds of each fork.

    Leaves are the held words in order of their hashes, then the other words of each shared
    class. `odds` is the log of how much more often words take the branch of the bit 1 than the
    other.
    """

    first: np.ndarray
    rows: np.ndarray
    bits: np.ndarray
    odds: np.ndarray

    def forks(self, leaves: np.ndarray) -> Forks:
        start, count = self.first[leaves], self.first[leaves + 1] - self.first[leaves]
        places = np.flatnonzero(count)
        start, count = start[places], count[places]
        first = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(start - first[:-1], count) + np.arange(first[-1])
        rows = self.rows.take(at)
        return Forks(places, first, rows, self.bits.take(at), self.odds.take(rows))


@dataclass
class Forks:
    """Numbers of words in order, where the forks of each begin, with the end, and by fork its
    row of weights, the bit taken and the odds."""

    places: np.ndarray
    first: np.ndarray
    rows: np.ndarray
    bits: np.ndarray
    odds: np.ndarray

    def of(self, low: int, high: int) -> Forks:
        """Those of the words from `low` to before `high`, whose numbers begin at 0."""
        a, b = np.searchsorted(self.places, [low, high])
        part = slice(self.first[a], self.first[b])
        first = self.first[a : b + 1] - self.first[a]
        return Forks(self.places[a:b] - low, first, self.rows[part], self.bits[part], self.odds[part])

    def owners(self) -> np.ndarray:
        return np.repeat(self.places, np.diff(self.first))


def huffman(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node of a Huffman tree its parent, whether it is the parent's second branch, and
    its weight. Leaves come first, as given, then inner nodes; the last one is the root.

    Leaves sorted by weight and inner nodes, which arise by weight, are two queues.
    """
    count = len(weights)
    order = np.argsort(weights, kind="stable").tolist()
    weight = weights.tolist() + [0.0] * (count - 1)
    parent, second = [-1] * len(weight), [False] * len(weight)
    leaf, inner = 0, count
    for node in range(count, len(weight)):
        for branch in (False, True):
            if leaf < count and (inner >= node or weight[order[leaf]] <= weight[inner]):
                taken, leaf = order[leaf], leaf + 1
            else:
                taken, inner = inner, inner + 1
            parent[taken], second[taken] = node, branch
            weight[node] += weight[taken]
    return np.array(parent), np.array(second), np.array(weight)


def fork_paths(classes: np.ndarray, counts: np.ndarray, rest: np.ndarray) -> Paths:
    """The paths to all leaves, from classes and counts of held words, and the counts of the
    other words of each shared class."""
    leaves = len(classes) + SHARED_CLASSES
    of_class = np.concatenate([classes, OWN_CLASSES + np.arange(SHARED_CLASSES)])
    weights = np.concatenate([counts, rest])
    # All trees in one numbering: leaves, then the inner nodes of one class after another.
    parent, second, weight = np.full(leaves, -1), np.zeros(leaves, bool), weights
    for number in range(OWN_CLASSES, CLASSES):
        members = np.flatnonzero((of_class == number) & (weights > 0))
        if len(members) < 2:
            continue
        up, branch, sums = huffman(weights[members])
        ids = np.concatenate([members, len(parent) + np.arange(len(members) - 1)])
        parent = np.concatenate([parent, np.full(len(members) - 1, -1)])
        second = np.concatenate([second, np.zeros(len(members) - 1, bool)])
        weight = np.concatenate([weight, sums[len(members) :]])
        parent[ids] = np.where(up < 0, -1, ids[up])
        second[ids] = branch
    inner = np.arange(leaves, len(parent))
    heaviest = inner[np.argsort(-weight[inner], kind="stable")[:FORK_ROWS]]
    row = np.full(len(parent), -1)
    row[heaviest] = np.arange(len(heaviest))
    odds = np.zeros(max(1, len(heaviest)), np.float32)
    for branch, sign in ((True, 1), (False, -1)):
        children = np.flatnonzero((parent >= 0) & (second == branch))
        told = children[row[parent[children]] >= 0]
        odds[row[parent[told]]] += sign * np.log(weight[told])
    found = []
    at = np.arange(leaves)
    leaf = at
    while len(at):
        up = parent[at]
        inside = up >= 0
        at, leaf, up = at[inside], leaf[inside], up[inside]
        weighted = row[up] >= 0
        found.append((leaf[weighted], row[up[weighted]], second[at[weighted]]))
        at = up
    owner, rows, bits = (np.concatenate(column) for column in zip(*found))
    order = np.argsort(owner, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=leaves))])
    return Paths(first, rows[order].astype(np.uint16), bits[order], odds)


# Frequent words whose counts every task holds, all others being joined, and input rows that
# rarer words share.
MOST_WORDS = 200_000
SHARED_INPUTS = 64
EDGE_INPUT = INPUTS + SHARED_INPUTS


def _shared_class(hashes: np.ndarray) -> np.ndarray:
    return (OWN_CLASSES + hashes % np.uint64(SHARED_CLASSES)).astype(np.int64)


def _shared_input(hashes: np.ndarray) -> np.ndarray:
    return (INPUTS + (hashes >> np.uint64(8)) % np.uint64(SHARED_INPUTS)).astype(np.int64)


def _word_hashes(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of texts and hashes of their words, for some texts at a time."""
    for numbers, held in W.pieces([(text or "").lower() for text in texts]):
        joined = W.Texts(held)
        starts, ends = W.words(joined)
        yield np.array(numbers, np.int64)[joined.text_of(starts)], joined.hashes(starts, ends)


def _count_task(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[int, int] = {}

    def counted() -> pd.DataFrame:
        words = np.fromiter(held.keys(), np.uint64, len(held)).view(np.int64)
        return pd.DataFrame({"word": words, "n": np.fromiter(held.values(), np.int64, len(held))})

    for batch in batches:
        for _, found in _word_hashes([None if pd.isna(t) else t for t in batch["text"]]):
            codes, keys = pd.factorize(found)
            for key, n in zip(keys.tolist(), np.bincount(codes, minlength=len(keys)).tolist()):
                held[key] = held.get(key, 0) + n
            if len(held) > 500_000:
                yield counted()
                held.clear()
    yield counted()


def vocabulary(texts: DataFrame) -> Vocabulary:
    """Counts over all texts. To the driver come MOST_WORDS words and a sum for each class."""
    with passing_tables(texts.sparkSession):
        return _vocabulary(texts)[0]


def _vocabulary(texts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the count of every word in a written table."""
    counted = texts.mapInPandas(_count_task, "word long, n long")
    counts = written(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    top = most_frequent(counts, "n", MOST_WORDS).toPandas()
    top = top.sort_values(["n", "word"], ascending=[False, True])
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    n = top["n"].to_numpy(np.float64)
    classes, inputs = _shared_class(hashes), _shared_input(hashes)
    classes[:OWN_CLASSES] = np.arange(len(classes[:OWN_CLASSES]))
    inputs[:INPUTS] = np.arange(len(inputs[:INPUTS]))
    # A power of two leaves the same remainder of a signed as of an unsigned number.
    word_class = F.pmod(F.col("word"), F.lit(SHARED_CLASSES)).cast("int")
    sums = counts.groupBy(word_class.alias("k")).agg(F.sum("n").alias("n"))
    every = np.zeros(SHARED_CLASSES)
    for row in sums.collect():
        every[row["k"]] = row["n"]
    remainder = (hashes % np.uint64(SHARED_CLASSES)).astype(int)
    rest = every - np.bincount(remainder, n, SHARED_CLASSES)
    totals = np.bincount(classes, n, CLASSES).astype(np.float64)
    totals[OWN_CLASSES:] += rest
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = np.log(n / totals[classes])
    rest_all = np.zeros(CLASSES)
    rest_all[OWN_CLASSES:] = np.where(rest > 0, np.nan, 0)
    order = np.argsort(hashes)
    shares = np.log((totals + 0.5) / (totals + 0.5).sum())
    held = Vocabulary(
        hashes[order], inputs[order], classes[order], logs[order], rest_all, shares,
        fork_paths(classes[order], n[order], rest), totals,
    )
    return held, counts


# --- the network -------------------------------------------------------------------


@dataclass
class Network:
    """Rows for the words around, a scale for each position, weights of the classes and forks."""

    rows: np.ndarray
    scales: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    forks: np.ndarray

    @staticmethod
    def names() -> tuple[str, ...]:
        return ("rows", "scales", "bias", "out", "out_bias", "forks")

    @staticmethod
    def start(log_classes: np.ndarray) -> Network:
        """Small random weights; without context it gives the corpus's shares of classes
        and of words in them."""
        draw = np.random.default_rng(SEED)
        return Network(
            (draw.standard_normal((EDGE_INPUT + 1, HIDDEN)) * 0.3).astype(np.float32),
            np.ones((2 * WINDOW, HIDDEN), np.float32),
            np.zeros(HIDDEN, np.float32),
            (draw.standard_normal((HIDDEN, CLASSES)) * 0.1).astype(np.float32),
            log_classes.astype(np.float32),
            np.zeros((FORK_ROWS, HIDDEN), np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.names()])

    def with_flat(self, values: np.ndarray) -> Network:
        parts, at = [], 0
        for name in self.names():
            old = getattr(self, name)
            parts.append(values[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return Network(*parts)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        return self.hidden_from(self.rows.take(around, axis=0))

    def hidden_from(self, read: np.ndarray) -> np.ndarray:
        """The hidden units from the rows read at the places around."""
        return np.tanh(np.einsum("nph,ph->nh", read, self.scales) + self.bias)

    def log_chances(
        self, around: np.ndarray, classes: np.ndarray, forks: Forks | None = None
    ) -> np.ndarray:
        """log P(class | words around) of each example. With its forks, and by how much they
        move the log of its chance inside the class from what counts say."""
        hidden = self.hidden(around)
        scores = _times(hidden, self.out) + self.out_bias
        scores -= scores.max(axis=1, keepdims=True)
        chosen = scores[np.arange(len(classes)), classes]
        chosen = chosen - np.log(_times(np.exp(scores), np.ones((CLASSES, 1), np.float32))[:, 0])
        if forks is not None and len(forks.places):
            moved = np.einsum("nh,nh->n", self.forks.take(forks.rows, axis=0), hidden.take(forks.owners(), axis=0))
            moved += forks.odds
            sides = np.where(forks.bits, np.float32(-1), np.float32(1))
            moved = np.clip(moved * sides, -60, 60)
            change = np.log((1 + np.exp(sides * forks.odds)) / (1 + np.exp(moved)))
            chosen[forks.places] += np.add.reduceat(change, forks.first[:-1])
        return chosen


def _in_blocks(rows: np.ndarray) -> np.ndarray:
    """Rows in blocks of BLAS_ROWS, the last one filled up with zeros."""
    missing = -len(rows) % BLAS_ROWS
    if missing:
        rows = np.concatenate([rows, np.zeros((missing, rows.shape[1]), rows.dtype)])
    return rows.reshape(-1, BLAS_ROWS, rows.shape[1])


def _times(rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """rows @ matrix, block by block."""
    product = _in_blocks(rows) @ matrix
    return product.reshape(-1, matrix.shape[1])[: len(rows)]


def _across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b, block by block."""
    return (_in_blocks(a).transpose(0, 2, 1) @ _in_blocks(b)).sum(axis=0)


def _sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different row numbers in order, and the sum of the values of each."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # short numbers sort fastest
    held = rows[order]
    first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    return held[first], np.add.reduceat(values.take(order, axis=0), first)


class Trainer:
    """Steps of gradient descent whose rate falls with the squares of past gradients."""

    def __init__(self, network: Network):
        self.network = network
        self.squares = {n: np.full_like(getattr(network, n), 0.01) for n in network.names()}

    def step(self, around: np.ndarray, classes: np.ndarray, forks: Forks | None = None) -> None:
        net, count = self.network, len(classes)
        read = net.rows.take(around, axis=0)
        hidden = net.hidden_from(read)
        scores = _times(hidden, net.out) + net.out_bias
        scores -= scores.max(axis=1, keepdims=True)
        chances = np.exp(scores)
        chances /= chances.sum(axis=1, keepdims=True)
        chances[np.arange(count), classes] -= 1
        chances /= count
        back = _times(chances, net.out.T)
        if forks is not None and len(forks.places):
            weights = net.forks.take(forks.rows, axis=0)
            seen = hidden.take(forks.owners(), axis=0)
            moves = np.einsum("nh,nh->n", weights, seen)
            wrong = ((1 / (1 + np.exp(-forks.odds - moves)) - forks.bits) / count)[:, None]
            back[forks.places] += np.add.reduceat(wrong * weights, forks.first[:-1])
            touched, by_fork = _sums(forks.rows, wrong * seen)
            self._move("forks", by_fork, touched)
        back *= 1 - hidden * hidden
        by_place = np.einsum("nh,nph->ph", back, read)
        touched, by_row = _sums(around.ravel(), (back[:, None] * net.scales).reshape(-1, HIDDEN))
        self._move("rows", by_row, touched)
        self._move("scales", by_place)
        self._move("bias", back.sum(axis=0))
        self._move("out", _across(hidden, chances))
        self._move("out_bias", chances.sum(axis=0))

    def _move(self, name: str, gradient: np.ndarray, at: np.ndarray | None = None) -> None:
        squares, weights = self.squares[name], getattr(self.network, name)
        if at is None:
            squares += gradient * gradient * EXAMPLES
            weights -= gradient / np.sqrt(squares) * (RATE * EXAMPLES**0.5)
            return
        seen = squares.take(at, axis=0) + gradient * gradient * EXAMPLES
        squares[at] = seen
        weights[at] = weights.take(at, axis=0) - gradient / np.sqrt(seen) * (RATE * EXAMPLES**0.5)


def windows(owners: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    """The input rows around every word; beyond the ends of a text is the edge's row."""
    around = np.full((len(inputs), 2 * WINDOW), EDGE_INPUT, np.int64)
    for place, shift in enumerate([*range(-WINDOW, 0), *range(1, WINDOW + 1)]):
        if shift < 0:
            same = owners[-shift:] == owners[:shift]
            around[-shift:, place][same] = inputs[:shift][same]
        else:
            same = owners[shift:] == owners[:-shift]
            around[:-shift, place][same] = inputs[shift:][same]
    return around


CHUNK = 1024
# Forks are looked up for so many words at a time.
FORKED = 8192


def _train_task(batches: Iterable[pd.DataFrame], shared, stride: int) -> Iterator[pd.DataFrame]:
    words, network = shared.value
    trainer = Trainer(network.with_flat(network.flat()))
    seen = 0
    for batch in batches:
        for owners, found in _word_hashes([None if pd.isna(t) else t for t in batch["text"]]):
            inputs, classes, _, leaves = words.known(found)
            chosen = slice(seen % stride, None, stride)
            around, classes, leaves = windows(owners, inputs)[chosen], classes[chosen], leaves[chosen]
            for start in range(0, len(classes), FORKED):
                forks = words.paths.forks(leaves[start : start + FORKED])
                for low in range(start, min(start + FORKED, len(classes)), EXAMPLES):
                    step = slice(low, low + EXAMPLES)
                    through = forks.of(low - start, low - start + EXAMPLES)
                    trainer.step(around[step], classes[step], through)
            seen += len(found)
    if seen:
        flat = trainer.network.flat().astype(np.float64) * seen
        starts = range(0, len(flat), CHUNK)
        yield pd.DataFrame(
            {
                "chunk": [start // CHUNK for start in starts],
                "weights": [flat[start : start + CHUNK] for start in starts],
                "seen": float(seen),
            }
        )


def _sum_task(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of weights by chunk, holding one array for each chunk."""
    sums: dict[int, np.ndarray] = {}
    seen: dict[int, float] = {}
    for batch in batches:
        for chunk, weights, n in zip(batch["chunk"], batch["weights"], batch["seen"]):
            sums[chunk] = sums[chunk] + weights if chunk in sums else np.array(weights)
            seen[chunk] = seen.get(chunk, 0.0) + n
    if sums:
        yield pd.DataFrame(
            {"chunk": list(sums), "weights": list(sums.values()), "seen": [seen[c] for c in sums]}
        )


WEIGHTS = "chunk int, weights array<double>, seen double"


def train(
    texts: DataFrame, words: Vocabulary, rounds: int = ROUNDS, stride: int = STRIDE
) -> Network:
    """Average the weights that shards of the documents teach, round by round; each round reads
    its own share of them, so each text is read once.

    Rows go to rounds and shards by a hash of all columns of `texts`, and by it they are in order
    in a shard: the weights do not depend on how the rows are stored. A column of ids beside the
    text deals copies of a text to several shards.
    """
    network = Network.start(words.log_classes)
    shards = max(1, math.ceil(words.totals.sum() / rounds / SHARD_WORDS))
    dealt = texts.withColumn("_dealt", F.xxhash64(*texts.columns))
    for turn in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast((words, network))
        share = dealt.filter(F.pmod("_dealt", F.lit(rounds)) == turn)
        shard = F.pmod(F.xxhash64("_dealt"), F.lit(shards)).cast("int")
        ordered = share.repartitionById(shards, shard).sortWithinPartitions("_dealt")
        task = functools.partial(_train_task, shared=shared, stride=stride)
        learned = ordered.select("text").mapInPandas(task, WEIGHTS)
        summed = learned.repartition("chunk").mapInPandas(_sum_task, WEIGHTS)
        parts = sorted(summed.collect(), key=lambda row: row["chunk"])
        if parts:
            flat = np.concatenate([np.array(row["weights"]) / row["seen"] for row in parts])
            network = network.with_flat(flat)
    return network


# --- scores ------------------------------------------------------------------------


def score(words: Vocabulary, network: Network, texts: list[str | None]):
    """Number of words and log pseudo-likelihood of each whole text.

    For words that the vocabulary does not hold, log P(word | class) is not in the sum;
    `_scored` tells them.
    """
    return _scored(words, network, texts)[:2]


def _scored(words: Vocabulary, network: Network, texts: list[str | None]):
    """As `score`, and the hashes of words to be joined, by text."""
    n_words, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    rest_owners, rest = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for owners, found in _word_hashes(texts):
        inputs, classes, logs, leaves = words.known(found)
        around = windows(owners, inputs)
        unheld = np.isnan(logs)
        rest_owners.append(owners[unheld])
        rest.append(found[unheld])
        logs[unheld] = 0
        for low in range(0, len(found), FORKED):
            part = slice(low, low + FORKED)
            forks = words.paths.forks(leaves[part])
            logs[part] += network.log_chances(around[part], classes[part], forks)
        n_words += np.bincount(owners, minlength=len(texts))
        total += np.bincount(owners, logs, len(texts))
    # Texts come in order, so the hashes do too.
    ends = np.cumsum(np.bincount(np.concatenate(rest_owners), minlength=len(texts)))
    flat = np.concatenate(rest).view(np.int64)
    lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), flat)
    return n_words, total, lists


def _score_task(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    words, network = shared.value
    for batch in batches:
        n_words, total, rest = _scored(words, network, batch.column(1).to_pylist())
        columns = [batch.column(0), pa.array(n_words), pa.array(total), rest]
        yield pa.RecordBatch.from_arrays(columns, [*COLUMNS[:3], "rest"])


def _with_rest(scored: DataFrame, words: Vocabulary, counts: DataFrame) -> DataFrame:
    """The rows with log P(word | class) of their `rest` added, from the count of every word."""
    rows = written(scored.withColumn("row", F.monotonically_increasing_id()), "likelihoods")
    totals = F.array(*[F.lit(float(n)) for n in words.totals[OWN_CLASSES:]])
    word_class = F.pmod(F.col("word"), F.lit(SHARED_CLASSES)).cast("int")
    log = F.log(F.col("n") / F.get(totals, word_class))
    places = rows.select("row", F.explode("rest").alias("word"))
    # The table of counts grows with the corpus, so it is never broadcast.
    added = places.join(counts.hint("merge"), "word").groupBy("row").agg(F.sum(log).alias("added"))
    joined = rows.join(added.hint("merge"), "row", "left")
    total = F.col("log_likelihood") + F.coalesce("added", F.lit(0.0))
    return written(joined.select("doc_id", "n_words", total.alias("log_likelihood")), "scores", keep=True)


def score_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, log_likelihood and its mean by word, for every whole text.

    Words are lower-cased runs of letters, single digits and runs of other signs. A text that
    is null, empty or blank has no words, the sum 0 and a null mean. Rows are scored one by one:
    repeated rows and null ids come out as they came in. A very long text is read in parts cut
    between words, at which its windows end. Other columns are not read; an empty table gives
    no rows.
    """
    chosen = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    texts = chosen.filter("text IS NOT NULL")
    with passing_tables(documents.sparkSession):
        words, counts = _vocabulary(texts.select("text"))
        network = train(texts, words)
        shared = documents.sparkSession.sparkContext.broadcast((words, network))
        scored = chosen.mapInArrow(functools.partial(_score_task, shared=shared), SCORED)
        if np.isnan(words.rest_log_in_class).any():
            scored = _with_rest(scored, words, counts)
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return scored.select(*COLUMNS[:3], mean.alias(COLUMNS[3]))
