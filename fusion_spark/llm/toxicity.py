"""Toxicity: averaged subword embeddings with a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.labels import platt, sample, sigmoid
from fusion_spark.llm.words import slices, texts_of

BUCKETS = 1 << 16
SIZES = (3, 4, 5)
DIMENSIONS = 8
WINDOW = 8  # words averaged into one vector; a text is as toxic as its worst window
PER_CLASS = 800  # bound of the training sample
SAMPLE_BYTES = 32 << 20  # and of its texts, per class
THRESHOLD = 0.7
CACHE_WORDS = 500_000
WORD = re.compile(r"\w+")


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every character n-gram of every ``<word>``, by word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = "<" + "><".join(words) + ">"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(lengths), lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    owners, buckets = [], []
    place = np.arange(len(points))
    for size in SIZES:
        code = np.full(max(0, len(points) - size + 1), size, np.uint64)
        for step in range(size):
            code = (code ^ points[step:step + len(code)]) * np.uint64(0x100000001B3)
        code ^= code >> np.uint64(29)
        whole = place[: len(code)] + size <= ends[: len(code)]
        owners.append(owner[: len(code)][whole])
        buckets.append((code[whole] % np.uint64(BUCKETS)).astype(np.int64))
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    return owners[order], buckets[order]


def add_up(index: np.ndarray, rows: np.ndarray, length: int) -> np.ndarray:
    return np.stack([np.bincount(index, rows[:, d], length) for d in range(rows.shape[1])], 1)


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def worst_window(values: np.ndarray) -> float:
    """Largest mean over ``WINDOW`` consecutive words (over all, if there are fewer).

    A word that was seen less than a window before counts nothing again, so a text that
    repeats one word over and over is judged by it once.
    """
    if len(values) == 0:
        return 0.0
    order = np.argsort(values, kind="stable")
    again = (np.diff(values[order]) == 0) & (np.diff(order) < WINDOW)
    values = values.copy()
    values[order[1:][again]] = 0
    if len(values) <= WINDOW:
        return float(values.mean())
    sums = np.cumsum(np.concatenate([[0.0], values]))
    return float((sums[WINDOW:] - sums[:-WINDOW]).max() / WINDOW)


@dataclass
class Model:
    """``worth``: logit that each subword adds; a word has the mean of its subwords."""

    worth: np.ndarray
    slope: float
    shift: float

    def word_values(self, words: list[str]) -> np.ndarray:
        owner, bucket = subwords(words)
        count = np.bincount(owner, minlength=len(words))
        return np.bincount(owner, self.worth[bucket], len(words)) / np.maximum(count, 1)

    def score(self, value: float) -> float:
        return float(sigmoid(np.float64(self.slope * value + self.shift)))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start .. start + size - 1 of every range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


class Windows:
    """Distinct words of every window of the training texts, as flat 32-bit arrays."""

    def __init__(self, rows: list[tuple[str, int]]):
        self.known: dict[str, int] = {}
        word, begin, own, source, toxic = (array(kind) for kind in "iibib")
        for number, (text, label) in enumerate(rows):
            ids = [self.known.setdefault(each, len(self.known)) for each in tokens(text)]
            for start in range(0, len(ids), WINDOW):
                begin.append(len(word))
                word.extend(dict.fromkeys(ids[start:start + WINDOW]))
                own.append(min(WINDOW, len(ids)))
                source.append(number)
                toxic.append(label)
        begin.append(len(word))
        self.word, self.begin = np.array(word, np.int32), np.array(begin, np.int32)
        self.divisor = np.array(own, np.float32)
        self.source, self.toxic = np.array(source, np.int32), np.array(toxic, np.int8)

    def __len__(self) -> int:
        return len(self.source)


class Network:
    """Subword table, softmax and bias with their Adam moments, all of 32-bit floats."""

    def __init__(self, windows: Windows, rate: float):
        owner, bucket = subwords(list(windows.known))
        self.windows, self.rate, self.steps = windows, rate, 0
        self.pieces = np.bincount(owner, minlength=len(windows.known)).astype(np.int32)
        self.at = (np.cumsum(self.pieces) - self.pieces).astype(np.int64)
        self.used, bucket = np.unique(bucket, return_inverse=True)
        self.bucket = bucket.astype(np.int32)
        random = np.random.default_rng(5)
        self.parts = [
            random.normal(0, 0.1, shape).astype(np.float32)
            for shape in ((len(self.used), DIMENSIONS), (DIMENSIONS, 2))
        ] + [np.zeros(2, np.float32)]
        self.restart()

    def restart(self) -> None:
        self.steps = 0
        self.moments = [(np.zeros_like(part), np.zeros_like(part)) for part in self.parts]

    def forward(self, chosen: np.ndarray) -> tuple:
        """Class shares of the chosen windows, and what the way back needs."""
        table, softmax, bias = self.parts
        sizes = np.diff(self.windows.begin)[chosen]
        words, word = np.unique(
            self.windows.word[_ranges(self.windows.begin[chosen], sizes)], return_inverse=True)
        pieces = self.pieces[words]
        bucket = self.bucket[_ranges(self.at[words], pieces)]
        vectors = np.add.reduceat(table[bucket], np.cumsum(pieces) - pieces)
        vectors /= pieces[:, None]
        mean = np.add.reduceat(vectors[word], np.cumsum(sizes) - sizes)
        mean /= self.windows.divisor[chosen][:, None]
        logits = mean @ softmax + bias
        shares = np.exp(logits - logits.max(1, keepdims=True))
        return shares / shares.sum(1, keepdims=True), mean, sizes, word, pieces, bucket

    def step(self, chosen: np.ndarray, weight: np.ndarray) -> None:
        """One Adam step on the weighted cross entropy of the chosen windows."""
        table, softmax, _ = self.parts
        shares, mean, sizes, word, pieces, bucket = self.forward(chosen)
        error = (shares - np.eye(2, dtype=np.float32)[self.windows.toxic[chosen]])
        error *= weight[:, None]
        back = (error @ softmax.T) / self.windows.divisor[chosen][:, None]
        down = add_up(word, np.repeat(back, sizes, 0), len(pieces)) / pieces[:, None]
        slopes = [
            add_up(bucket, np.repeat(down, pieces, 0), len(table)) + 1e-6 * table,
            mean.T @ error + 1e-4 * softmax, error.sum(0),
        ]
        self.steps += 1
        for part, slope, (first, second) in zip(self.parts, slopes, self.moments, strict=True):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            part -= self.rate * (first / (1 - 0.9 ** self.steps)) / (
                np.sqrt(second / (1 - 0.99 ** self.steps)) + 1e-8)

    def toxic_shares(self, batch: int) -> np.ndarray:
        every = np.arange(len(self.windows))
        return np.concatenate([
            self.forward(every[start:start + batch])[0][:, 1]
            for start in range(0, len(every), batch)])


def train(
    rows: list[tuple[str, int]], passes: int = 3, rate: float = 0.05, batch: int = 4096,
    steps: int = 30,
) -> Model:
    """Fits embeddings and softmax on windows of the sample, then twice more on the windows
    that carry the label: of a toxic text those scored toxic and its worst one.

    A step takes ``batch`` windows, so memory beyond the sample's own word numbers, four bytes
    a word, does not follow its size. Each of the three rounds makes ``passes`` over the
    windows, but ``steps`` steps at least.

    The last third of the rows only fixes the scale of the score, at which toxic and other
    texts weigh the same. Every subword of the sample is fitted, however rare. Without both
    classes the score is 0 for every text.
    """
    if len({label for _, label in rows}) < 2:
        return Model(np.zeros(BUCKETS), 0.0, -40.0)
    split = [[row for row in rows if row[1] == label] for label in (0, 1)]
    fit = [row for part in split for row in part[: max(1, 2 * len(part) // 3)]]
    held = [row for part in split for row in part[max(1, 2 * len(part) // 3):]] or fit
    windows = Windows(fit)
    if not len(windows):
        return Model(np.zeros(BUCKETS), 0.0, -40.0)
    network = Network(windows, rate)
    random = np.random.default_rng(7)
    toxic = windows.toxic == 1
    taking = np.ones(len(windows), bool)
    for _ in range(3):
        taken = np.flatnonzero(taking)
        each = [0.5 / max(1, (toxic[taken] == label).sum()) for label in (False, True)]
        weight = np.where(toxic, each[1], each[0]).astype(np.float32)
        network.restart()
        per_pass = -(-len(taken) // batch)
        for _ in range(max(passes, -(-steps // per_pass))):
            random.shuffle(taken)
            for start in range(0, len(taken), batch):
                chosen = taken[start:start + batch]
                network.step(chosen, weight[chosen] * np.float32(len(taken) / len(chosen)))
        shares = network.toxic_shares(batch)
        worst = np.zeros(len(fit), np.float32)
        np.maximum.at(worst, windows.source, shares)
        taking = ~toxic | (shares >= 0.5) | (shares >= worst[windows.source])
    table, softmax, _ = network.parts
    worth = np.zeros(BUCKETS)
    worth[network.used] = table @ (softmax[:, 1] - softmax[:, 0])
    del network, windows
    model = Model(worth, 1.0, 0.0)
    values = np.array([worst_window(model.word_values(tokens(text))) for text, _ in held])
    slope, shift = platt(values, np.array([label for _, label in held]))
    return Model(worth, max(slope, 0.0), shift)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Trains on at most ``per_class`` labelled documents of each class among the usable rows,
    together at most ``sample_bytes`` bytes a class."""
    return train(sample(
        docs, labels, "toxic", usable, per_class, most_bytes=sample_bytes))


def _scores(batch: pa.RecordBatch, state: dict) -> np.ndarray:
    """Scores of a batch; ``state`` holds the model and the values of the words seen so far."""
    own = Model(state["worth"], state["slope"], state["shift"])
    known = state.setdefault("known", {})
    if len(known) > CACHE_WORDS:
        known.clear()
    found = [tokens(text) for text in texts_of(batch, "text")]
    new = list(set().union(*found).difference(known))
    known.update(zip(new, own.word_values(new).tolist(), strict=True))
    return np.array([
        own.score(worst_window(np.fromiter(
            map(known.__getitem__, words), np.float64, len(words))))
        for words in found
    ])


def _shared(docs: DataFrame, model: Model):
    return docs.sparkSession.sparkContext.broadcast(
        {"worth": model.worth, "slope": model.slope, "shift": model.shift})


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row; the score is between 0 and 1.

    The whole text is scored, by the worst of its windows. Null and empty texts and texts
    without a word have the score of a window of value 0. Repeated rows give repeated
    results, an empty table an empty one; no column but ``doc_id`` and ``text`` is read.
    """
    shared = _shared(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_scores(batch, shared.value), pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double"
    )


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below ``threshold``."""
    shared = _shared(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(_scores(batch, shared.value) < threshold))

    return docs.mapInArrow(run, docs.schema)
