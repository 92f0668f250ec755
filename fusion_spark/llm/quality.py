"""Quality: positive-unlabelled learning with the non-negative unbiased risk."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.labels import sample, sigmoid
from fusion_spark.llm.words import slices, texts_of

POSITIVES = 2000  # bound of the trusted positives
UNLABELLED = 4000  # bound of the unlabelled texts
THRESHOLD = 0.3
HIDDEN = 16
STEEPNESS = 3.0
SINGLE = ".,;:!?|#$%&*\"'()[]{}<>=/\\_-+@~^"  # signs that are counted each for itself

_KINDS = np.zeros((256, 5 + len(SINGLE)))
for _code in range(256):
    _char = chr(_code)
    _KINDS[_code, :5] = (
        _char.isalpha(), _char.isupper(), _char.isdigit(), _char.isspace(), _code == 10
    )
for _place, _char in enumerate(SINGLE):
    _KINDS[ord(_char), 5 + _place] = 1


# typographic signs without a compatibility form, counted like their plain ones
_PLAIN = dict(zip(
    "\u2018\u2019\u201c\u201d\u2010\u2012\u2013\u2014\u3001\u3002", "''\"\"----,.", strict=True))
_OTHER: dict[int, np.ndarray] = {}  # kinds of the characters beyond Latin-1 seen so far


def _kinds_of(code: int) -> np.ndarray:
    """Kinds of any character; marks count as letters, wide signs like their plain ones."""
    if code < 256:
        return _KINDS[code]
    if code not in _OTHER:
        char = chr(code)
        row = np.zeros(_KINDS.shape[1])
        row[:5] = (char.isalpha() or unicodedata.category(char)[0] == "M", char.isupper(),
                   char.isdigit(), char.isspace(), False)
        plain = _PLAIN.get(char) or unicodedata.normalize("NFKC", char)[:1]
        if plain in SINGLE and not row[0]:
            row[5 + SINGLE.index(plain)] = 1
        _OTHER[code] = row
    return _OTHER[code]


def kinds_of(text: str) -> np.ndarray:
    """How many characters of the text are of each kind."""
    try:
        raw = np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes, uses = np.unique(points, return_counts=True)
        return uses @ np.array([_kinds_of(code) for code in codes.tolist()])
    return np.bincount(raw, minlength=256) @ _KINDS


def features(text: str) -> np.ndarray:
    """Shares of kinds of characters, word lengths, and how much words and lines repeat."""
    kinds = kinds_of(text) / max(1, len(text))
    words = text.split()
    count = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    uses = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    in_a_row = sum(map(str.__eq__, words, words[1:]))
    ends = sum(map(kinds_of_end, words))
    return np.concatenate([
        np.sqrt(kinds),
        [
            np.log1p(len(words)), np.log1p(len(lines)), np.log1p(count / max(1, len(lines))),
            lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths >= 12).mean(),
            len(uses) / count, len(uses) / count ** 0.75,
            max(uses.values(), default=0) / count, in_a_row / count,
            len(set(lines)) / max(1, len(lines)), ends / count,
            np.log1p(max(map(len, lines), default=0)),
        ],
    ])


def kinds_of_end(word: str) -> bool:
    return not word[-1].isalnum()


@dataclass
class Model:
    """A small network over standardised features."""

    center: np.ndarray
    scale: np.ndarray
    parts: list[np.ndarray]
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(_forward(self.parts, self._standard(rows))[1])

    def _standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.center) / self.scale, -6, 6)


def _forward(parts: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, shift, second, bias = parts
    hidden = np.tanh(rows @ first + shift)
    return hidden, hidden @ second + bias[0]


def _descend(rows: np.ndarray, slope_of, steps: int, rate: float = 0.02) -> list[np.ndarray]:
    """Adam over the network; ``slope_of`` turns outputs into the risk's slope at each."""
    random = np.random.default_rng(10)
    parts = [random.normal(0, 0.3, (rows.shape[1], HIDDEN)) / np.sqrt(rows.shape[1]) * 2,
             np.zeros(HIDDEN), random.normal(0, 0.3, HIDDEN), np.zeros(1)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in parts]
    for step in range(1, steps + 1):
        hidden, out = _forward(parts, rows)
        error = slope_of(out)
        back = np.outer(error, parts[2]) * (1 - hidden ** 2)
        slopes = [rows.T @ back + 1e-4 * parts[0], back.sum(0),
                  hidden.T @ error + 1e-4 * parts[2], np.array([error.sum()])]
        for part, slope, (one, two) in zip(parts, slopes, moments, strict=True):
            one += 0.1 * (slope - one)
            two += 0.01 * (slope * slope - two)
            part -= rate * (one / (1 - 0.9 ** step)) / (
                np.sqrt(two / (1 - 0.99 ** step)) + 1e-8)
    return parts


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores that tell the two sets apart.

    Above any threshold the unlabelled hold at least prior times the positives' share; where
    negatives are rare the ratio of the two shares comes close to the prior.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.quantile(positive, np.linspace(0.02, 0.5, 25))
    above = [(unlabelled >= cut).mean() / max((positive >= cut).mean(), 1e-9) for cut in cuts]
    return float(np.clip(min(above), 0.05, 0.98))


def _risk(trusted: np.ndarray, prior: float):
    """Slope of prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the sigmoid loss."""

    def slope_of(out: np.ndarray) -> np.ndarray:
        p = sigmoid(out)
        bend = p * (1 - p)
        for_positive = np.where(trusted, -prior * bend / trusted.sum(), 0.0)
        for_negative = np.where(
            trusted, -prior * bend / trusted.sum(), bend / (~trusted).sum())
        negative = p[~trusted].mean() - prior * p[trusted].mean()
        # below zero the second term is lifted back instead of being fitted further
        return for_positive + for_negative if negative >= 0 else -for_negative

    return slope_of


def train(positive: list[str], unlabelled: list[str], steps: int = 400) -> Model:
    """Minimises the non-negative risk over trusted positives and unlabelled texts.

    With no positives every score is 0, with no unlabelled texts 1.
    """
    width = len(features(""))
    if not positive or not unlabelled:
        parts = [np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN),
                 np.array([40.0 if positive else -40.0])]
        return Model(np.zeros(width), np.ones(width), parts, float(bool(positive)))
    rows = np.array([features(text) for text in [*positive, *unlabelled]])
    trusted = np.arange(len(rows)) < len(positive)
    center, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-9] = 1.0
    model = Model(center, scale, [], 0.5)
    rows = model._standard(rows)
    # half of each set tells positives from the rest, the other half gives the prior
    half = np.arange(len(rows)) % 2 == 0
    prior = 0.5
    for _ in range(3):
        told = _forward(_descend(rows[half], _risk(trusted[half], prior), steps), rows[~half])[1]
        prior = class_prior(told[trusted[~half]], told[~trusted[~half]])
    parts = _descend(rows, _risk(trusted, prior), steps)
    # a text is as likely good as not where just a share ``prior`` of the unlabelled is above
    level = np.quantile(_forward(parts, rows[~trusted])[1], 1 - prior)
    parts[2], parts[3] = STEEPNESS * parts[2], STEEPNESS * (parts[3] - level)
    return Model(center, scale, parts, prior)


def fit_quality(
    docs: DataFrame, labels: DataFrame, usable: Column,
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> Model:
    """Trains on at most ``positives`` usable documents labelled 1 and ``unlabelled`` usable
    documents of any kind, each picked by a hash of the id of its own, so that the unlabelled
    are not the trusted ones over again."""
    trusted = sample(docs, labels, "quality", usable, positives, classes=(1,))
    any_kind = docs.select("doc_id").distinct().filter(usable).withColumn("any", F.lit(1))
    rest = sample(docs, any_kind, "any", F.lit(True), unlabelled, classes=(1,), seed=7)
    return train([text for text, _ in trusted], [text for text, _ in rest])


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row, the score between 0 and 1 and over the whole text.

    Null texts count as empty and are scored like any other. Repeated rows give repeated
    results, an empty table an empty one; no column but ``doc_id`` and ``text`` is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.center, model.scale, model.parts, model.prior)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in slices(batches):
            rows = np.array([features(text) for text in texts_of(batch, "text")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own.scores(rows), pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double"
    )
