"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word byte by byte in both directions and gives a probability of every
language at each position; a document's probability is the mean over all positions of all its
words.  It is trained by backpropagation through time in numpy, on the driver, on a bounded
sample of labelled documents, drawn language by language, and of each on pieces from all over
its text.  Words repeat, so each is read once per worker; the memory is bounded by ``CAPACITY``
words.  A word longer than ``WORD_BYTES`` is read in parts that end between characters.

Defined results: a text that is null or has no letter is ``und`` with score 0; without labelled
rows every text is ``und``; ties between languages go to the first in alphabetical order; the
whole text is read, whatever its length.

``accepted`` leaves out texts in none of the trained languages: their score falls behind what
pieces of labelled held-out documents of as many positions reach (``least_scores``).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from adrlens.llm.chunks import array_slices
from adrlens.llm.common import kept_by_worker, text_slices

UNKNOWN = "und"
WORD_BYTES = 32
CAPACITY = 300_000
BATCH = 4_096  # words read side by side
LETTER = re.compile(r"[^\W\d_]")
SIZES = 48  # classes of positions, by powers of two
LEAST_PIECES = 100  # of a class; with fewer, the bound of shorter texts holds


@dataclass(frozen=True)
class Training:
    """What bounds the sample that is collected, and how the network is trained.

    ``documents`` are drawn, as many of each language, but ``rare`` of each at least; of a text
    longer than ``pieces`` x ``characters``, so many pieces of so many characters are taken, one
    from each part of the text.
    """

    documents: int = 1_600
    rare: int = 20
    pieces: int = 8
    characters: int = 500
    hidden: int = 16
    steps: int = 400
    words: int = 512
    rate: float = 0.01
    seed: int = 7


@dataclass
class Cell:
    """Weights of one direction.  Gates are laid out as update, reset, candidate."""

    inputs: np.ndarray  # 256 x 3H, the row of a byte
    state: np.ndarray  # H x 3H

    @classmethod
    def start(cls, random: np.random.Generator, hidden: int) -> Cell:
        return cls(random.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
                   random.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def forward(cell: Cell, data: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (time x words x H); ``keep`` collects what the way back needs."""
    h2 = 2 * len(cell.state)
    state = np.zeros((data.shape[1], len(cell.state)), np.float32)
    states = np.empty((*data.shape, len(cell.state)), np.float32)
    for t, (byte, on) in enumerate(zip(data, mask)):
        x = cell.inputs[byte]
        gates = sigmoid(x[:, :h2] + state @ cell.state[:, :h2])
        update, reset = gates[:, :h2 // 2], gates[:, h2 // 2:]
        inner = np.tanh(x[:, h2:] + (reset * state) @ cell.state[:, h2:])
        new = on[:, None] * (1 - update) * (inner - state)
        if keep is not None:
            keep.append((state, update, reset, inner))
        state = state + new
        states[t] = state
    return states


def backward(cell: Cell, data: np.ndarray, mask: np.ndarray, kept: list, toward: np.ndarray) -> Cell:
    """Gradients of the weights; ``toward`` is the gradient of the states."""
    h = len(cell.state)
    inputs, weights = np.zeros_like(cell.inputs), np.zeros_like(cell.state)
    down = np.zeros(toward.shape[1:], np.float32)
    for t in range(len(data) - 1, -1, -1):
        state, update, reset, inner = kept[t]
        total, on = down + toward[t], mask[t][:, None]
        moved = total * on
        d_inner = moved * (1 - update) * (1 - inner * inner)
        d_update = -moved * (inner - state) * update * (1 - update)
        back = d_inner @ cell.state[:, 2 * h:].T
        d_reset = back * state * reset * (1 - reset)
        gates = np.concatenate([d_update, d_reset], 1)
        weights[:, :2 * h] += state.T @ gates
        weights[:, 2 * h:] += (reset * state).T @ d_inner
        np.add.at(inputs, data[t], np.concatenate([gates, d_inner], 1))
        down = (total - moved * (1 - update) + back * reset + gates @ cell.state[:, :2 * h].T)
    return Cell(inputs, weights)


@dataclass
class Network:
    ahead: Cell
    behind: Cell
    out: np.ndarray  # 2H x languages
    bias: np.ndarray

    @classmethod
    def start(cls, languages: int, training: Training) -> Network:
        random, h = np.random.default_rng(training.seed), training.hidden
        return cls(Cell.start(random, h), Cell.start(random, h),
                   random.normal(0, 0.1, (2 * h, languages)).astype(np.float32),
                   np.zeros(languages, np.float32))

    def digest(self) -> str:
        return sha256(b"".join(w.tobytes() for w in self.weights())).hexdigest()

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.state, self.behind.inputs, self.behind.state, self.out, self.bias]

    def positions(self, data: np.ndarray, mask: np.ndarray, kept: tuple[list, list] | None = None):
        """(states, probabilities) at every position (time x words)."""
        one, two = kept or (None, None)
        both = np.concatenate([forward(self.ahead, data, mask, one),
                               forward(self.behind, data[::-1], mask[::-1], two)[::-1]], 2)
        scores = both @ self.out + self.bias
        scores = np.exp(scores - scores.max(2, keepdims=True))
        return both, scores / scores.sum(2, keepdims=True)

    def gradients(self, data: np.ndarray, mask: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over all positions; ``target``: language of each word."""
        kept: tuple[list, list] = ([], [])
        both, wrong = self.positions(data, mask, kept)
        wrong[:, np.arange(len(target)), target] -= 1
        wrong *= (mask / mask.sum())[:, :, None]
        toward = wrong @ self.out.T
        h = len(self.ahead.state)
        ahead = backward(self.ahead, data, mask, kept[0], toward[:, :, :h])
        behind = backward(self.behind, data[::-1], mask[::-1], kept[1], toward[::-1, :, h:])
        return [ahead.inputs, ahead.state, behind.inputs, behind.state,
                np.einsum("twh,twl->hl", both, wrong), wrong.sum((0, 1))]


def spelled(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, mask), both time x words; a word ends with a blank."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data = np.full((int(lengths.max(initial=1)), len(words)), ord(" "), np.uint8)
    for i, word in enumerate(words):
        data[:len(word), i] = np.frombuffer(word, np.uint8)
    return data, (np.arange(len(data))[:, None] < lengths).astype(np.float32)


def split_words(text: str) -> list[str]:
    return text.split()


def parts_of(word: str) -> list[bytes]:
    """The word's bytes in parts of at most ``WORD_BYTES``, cut between characters."""
    raw, begin, parts = word.encode(), 0, []
    while len(raw) - begin > WORD_BYTES:
        end = begin + WORD_BYTES
        while raw[end] & 0xC0 == 0x80:  # inside a character
            end -= 1
        parts.append(raw[begin:end])
        begin = end
    return [*parts, raw[begin:]]


@dataclass
class Model:
    languages: list[str]
    network: Network | None

    def reader(self) -> Reader:
        """Reader of this worker, kept with its words for the tasks that follow."""
        key = (*self.languages, self.network.digest() if self.network else "")
        return kept_by_worker("language", "reader", key, lambda: Reader(self))

    @classmethod
    def train(cls, texts: Sequence[str], labels: Sequence[str], training: Training = Training()) -> Model:
        languages = sorted(set(labels))
        pairs = [(part, languages.index(label)) for text, label in zip(texts, labels)
                 for word in split_words(text) for part in parts_of(word)]
        if not pairs:
            return cls(languages, None)
        by_language = [[p for p, n in pairs if n == i] for i in range(len(languages))]
        languages = [name for name, own in zip(languages, by_language) if own]
        by_language = [own for own in by_language if own]
        network, random = Network.start(len(languages), training), np.random.default_rng(training.seed + 1)
        weights = network.weights()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, training.steps + 1):
            target = random.integers(len(languages), size=training.words)
            words = [by_language[n][random.integers(len(by_language[n]))] for n in target]
            for w, g, m, v in zip(weights, network.gradients(*spelled(words), target), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                fade = training.rate * (1 - step / (training.steps + 1))
                w -= fade * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return cls(languages, network)


class Reader:
    """Sums of position probabilities per word, kept for the words that return."""

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.sums = np.zeros((CAPACITY, len(model.languages) + 1), np.float32)

    def _read(self, words: list[str]) -> np.ndarray:
        """Per word the sum of probabilities of each language, and the positions."""
        parts = [parts_of(w) for w in words]
        flat = [p for own in parts for p in own]
        order = sorted(range(len(flat)), key=lambda i: len(flat[i]))  # equal lengths together
        sums = np.empty((len(flat), self.sums.shape[1]), np.float32)
        for begin in range(0, len(order), BATCH):
            own = order[begin:begin + BATCH]
            data, mask = spelled([flat[i] for i in own])
            _, probability = self.model.network.positions(data, mask)
            sums[own, :-1] = np.einsum("twl,tw->wl", probability, mask)
            sums[own, -1] = mask.sum(0)
        ends = np.cumsum([len(own) for own in parts])
        return np.add.reduceat(sums, np.concatenate([[0], ends[:-1]]), axis=0)

    def _numbers(self, words: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(numbers < 0).tolist()
        if missing:
            new = list(dict.fromkeys(words[i] for i in missing))
            if len(self.number) + len(new) > len(self.sums):
                self.number.clear()
                if len(new) > len(self.sums):
                    self.sums = np.zeros((len(new), self.sums.shape[1]), np.float32)
                return self._numbers(words)
            have = len(self.number)
            self.sums[have:have + len(new)] = self._read(new)
            self.number.update(zip(new, range(have, have + len(new))))
            numbers[missing] = [self.number[words[i]] for i in missing]
        return numbers

    def predict(self, texts: Sequence[str]) -> Iterator[tuple[str, float]]:
        return ((language, score) for language, score, _ in self.judge(texts))

    def accept(self, texts: Sequence[str], least: Sequence[float]) -> Iterator[bool]:
        """Whether a text has a letter and its score reaches the bound of its size."""
        if not self.model.network:
            return (LETTER.search(t) is not None for t in texts)
        return (language != UNKNOWN and score >= least[size_of(positions)]
                for language, score, positions in self.judge(texts))

    def judge(self, texts: Sequence[str]) -> Iterator[tuple[str, float, int]]:
        """(language, score, positions) of each text."""
        for begin, end in text_slices(texts):
            words = [split_words(t) if self.model.network and LETTER.search(t) else [] for t in texts[begin:end]]
            numbers = self._numbers([w for own in words for w in own])
            at = 0
            for own in words:
                if not own:
                    yield UNKNOWN, 0.0, 0
                    continue
                total = self.sums[numbers[at:at + len(own)]].sum(0, dtype=np.float64)
                at += len(own)
                best = int(total[:-1].argmax())
                yield self.model.languages[best], min(1.0, float(total[best] / total[-1])), int(total[-1])


def size_of(positions: int) -> int:
    return min(positions.bit_length(), SIZES - 1)


def runs_of_words(text: str) -> Iterator[str]:
    """The text, and runs of 1, 2, 4, ... of its words from anywhere in it."""
    words, draw, count = split_words(text), random.Random(text), 1
    while count < len(words):
        begin = draw.randrange(len(words) - count + 1)
        yield " ".join(words[begin:begin + count])
        count *= 2
    yield text


def scores_by_size(reader: Reader, texts: Sequence[str]) -> dict[int, tuple[float, int]]:
    """Per size the lowest score of the texts' pieces, and their number."""
    found: dict[int, tuple[float, int]] = {}
    for text in texts:
        for language, score, positions in reader.judge(list(runs_of_words(text))):
            if language != UNKNOWN:
                lowest, count = found.get(size_of(positions), (1.0, 0))
                found[size_of(positions)] = min(lowest, score), count + 1
    return found


def bounds(found: Mapping[int, tuple[float, int]], languages: int) -> list[float]:
    """Per size the score that a text must reach, from the lowest scores of clean pieces.

    It lies midway between chance and the worst piece of that size or of any larger one, so it
    rises with the size.
    """
    worst, chance = 1.0, 1 / max(1, languages)
    least: list[float | None] = [None] * SIZES
    for size in range(SIZES - 1, -1, -1):
        lowest, count = found.get(size, (1.0, 0))
        worst = min(worst, lowest)
        if count >= LEAST_PIECES:
            least[size] = (worst + chance) / 2 - 1e-3  # for rounding
    bound, out = 0.0, []
    for own in least:
        bound = bound if own is None else max(0.0, own)
        out.append(bound)
    return out


def held_out(id_: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo ``parts``."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % parts == part, F.lit(False))


def _labelled(docs: DataFrame, kept: Column, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """(order, id, text, lang) of labelled documents; ``order`` shuffles them, the same on every run."""
    return (docs.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull() & F.col(id_column).isNotNull() & kept)
            .select(F.xxhash64(id_column).alias("order"), F.col(id_column).alias("id"),
                    F.col(text_column).alias("text"), F.col(label_column).alias("lang")))


def _drawn(rows: DataFrame, drawn: DataFrame) -> DataFrame:
    """The labelled documents that were drawn; of rows that share id and language one text."""
    return (rows.join(F.broadcast(drawn), ["order", "id", "lang"], "left_semi")  # a bounded sample
            .groupBy("order", "id", "lang").agg(F.min("text").alias("text")))


def _pieces(text: Column, pieces: int, characters: int) -> Column:
    """Pieces of a text, one from each of as many equal parts; a short text is one piece."""
    size = F.length(text)
    part = size / pieces

    def piece(i: Column) -> Column:
        room = F.greatest(part - characters, F.lit(0))
        start = F.floor(i * part + room * F.pmod(F.xxhash64(text, i), F.lit(1000)) / 1000)
        return F.substring(text, (start + 1).cast("int"), F.lit(characters))

    return F.when(size > pieces * characters, F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), piece)).otherwise(F.array(text))


def _whole_words(pieces: Sequence[str]) -> str:
    """The pieces' words, without those that a cut may have shortened."""
    if len(pieces) == 1:
        return pieces[0]
    words = map(split_words, pieces)
    return " ".join(w for own in words for w in (own[1:-1] if len(own) > 2 else own))


def learn(docs: DataFrame, training: Training = Training(), id_column: str = "doc_id",
          text_column: str = "text", label_column: str = "lang") -> Model:
    """Model from labelled documents that are not held out; the sample is the same on every run."""
    rows = _labelled(docs, ~held_out(F.col(id_column)), id_column, text_column, label_column)
    languages = rows.select("lang").distinct().count()
    each = max(training.rare, training.documents // max(1, languages))
    place = F.dense_rank().over(W.partitionBy("lang").orderBy("order", "id"))
    drawn = rows.select("order", "id", "lang").distinct().withColumn("place", place).where(F.col("place") <= each)
    sample = (_drawn(rows, drawn.drop("place"))  # at most ``documents``, or ``rare`` of each language
              .select("lang", "order", "id", _pieces(F.col("text"), training.pieces, training.characters).alias("pieces"))
              .orderBy("lang", "order", "id").collect())
    return Model.train([_whole_words(r["pieces"]) for r in sample], [r["lang"] for r in sample], training)


def least_scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
                 label_column: str = "lang") -> list[float]:
    """``bounds`` from all labelled documents that are held out, whose whole texts are read by Spark."""
    if not model.network:
        return [0.0] * SIZES
    rows = (_labelled(docs, held_out(F.col(id_column)), id_column, text_column, label_column)
            .select(F.xxhash64("id", "lang", "text").alias("key"), "text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "key long, size int, lowest double, pieces long"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value.reader()
        for batch in batches:
            found = [(key, size, *least) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     for size, least in scores_by_size(reader, [text]).items()]
            columns = zip(*found) if found else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.int32(), pa.float64(), pa.int64()))], ["key", "size", "lowest", "pieces"])

    judged = (rows.mapInArrow(judge, schema)
              .groupBy("key", "size").agg(F.min("lowest").alias("lowest"), F.max("pieces").alias("pieces"))  # repeated rows count once
              .groupBy("size").agg(F.min("lowest").alias("lowest"), F.sum("pieces").alias("pieces")))
    return bounds({r["size"]: (r["lowest"], r["pieces"]) for r in judged.collect()}, len(model.languages))


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every document."""
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return classify(own, model).select(F.col("id").alias(id_column), "lang_pred", "score")


def classify(docs: DataFrame, model: Model, text_column: str = "text", language: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """``docs`` with the language and its score; both names must be free."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights
    at = docs.columns.index(text_column)
    schema = T.StructType([*docs.schema.fields, T.StructField(language, T.StringType()),
                           T.StructField(score, T.DoubleType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value.reader()
        for batch in batches:
            found = [f for own in array_slices(batch.column(at)) for f in reader.predict(own.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], schema.names)

    return docs.mapInArrow(read, schema)


def accepted(docs: DataFrame, model: Model, least: Sequence[float], text_column: str = "text") -> DataFrame:
    """The documents that have a letter and a score of at least the bound of their size (``least_scores``)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, least))
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, least = shared.value
        reader = model.reader()
        for batch in batches:
            yield batch.filter(pa.array([good for own in array_slices(batch.column(at))
                                         for good in reader.accept(own.to_pylist(), least)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
