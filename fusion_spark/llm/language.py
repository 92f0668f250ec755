"""Language ID: unigram pieces of a fixed vocabulary, summed over all segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.labels import sample
from fusion_spark.llm.words import slices, texts_of

PER_LANGUAGE = 200  # bound of the training documents of each language
ROUNDS = 3
NO_LANGUAGE = "und"
CACHE_BYTES = 1 << 26  # of scores of words that a worker keeps, and of their characters
BLOCK = 1 << 16  # characters of the words that are scored together, or one longer word
WORD = re.compile(r"[^\W\d_]+")


def vocabulary(path: str) -> list[str]:
    """Lower-case pieces of letters of a sentencepiece model, in the order of their ids.

    The mark of a word's start is kept as ``^``.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).replace("▁", "^") for i in range(len(model)))
    fitting = (p for p in pieces if p == p.lower() and re.fullmatch(r"\^?[^\W\d_]+", p))
    return list(dict.fromkeys(fitting))


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def blocks(found: Iterable[str]) -> Iterator[list[str]]:
    """The words by length, in lists of at most ``BLOCK`` characters or of one word."""
    block, size = [], 0
    for word in sorted(found, key=len):
        if block and size + len(word) > BLOCK:
            yield block
            block, size = [], 0
        block.append(word)
        size += len(word)
    if block:
        yield block


@dataclass
class Cuts:
    """Every place where a piece fits into words, by end, word and length.

    A word of n characters has n + 1 places, those of all words in a row.
    """

    first: np.ndarray  # place before each word
    last: np.ndarray  # place behind each word
    bounds: np.ndarray  # where the pieces of each end begin
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray


class Pieces:
    """Finds the pieces of a vocabulary in words by walking a trie from all places at once.

    Every single character is a piece: unlisted ones have the number ``size``.
    """

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        nodes = {"": 0}
        for piece in pieces:
            for n in range(1, len(piece) + 1):
                nodes.setdefault(piece[:n], len(nodes))
        self.of_node = np.full(len(nodes), -1, np.int64)
        self.of_node[[nodes[piece] for piece in pieces]] = np.arange(self.size)
        steps = sorted(((nodes[p[:-1]] << 21) + ord(p[-1]), node) for p, node in nodes.items() if p)
        self.steps, self.to = np.array([*steps, (1 << 62, 0)], np.int64).T

    def cuts(self, found: list[str]) -> Cuts:
        marked = ["^" + word for word in found]
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        joined = "".join(marked).encode("utf-32-le", "surrogatepass")
        chars = np.frombuffer(joined, np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(marked)), lengths)
        begin = np.cumsum(lengths) - lengths
        offset = np.arange(len(chars)) - begin[owner]
        at, node, n = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        hits = []
        while len(at):
            key = (node << 21) + chars[at + n]
            step = np.searchsorted(self.steps, key)
            known = self.steps[step] == key
            piece = np.where(known, self.of_node[self.to[step]], -1)
            n += 1
            if n == 1:
                piece[piece < 0] = self.size
            fits = piece >= 0
            hits.append((at[fits], np.full(fits.sum(), n), piece[fits]))
            going = known & (offset[at] + n < lengths[owner[at]])
            at, node = at[going], self.to[step[going]]
        at, size, piece = (np.concatenate(part) for part in zip(*hits, strict=True))
        behind = offset[at] + size
        order = np.lexsort((size, owner[at], behind))
        at, size, piece, behind = at[order], size[order], piece[order], behind[order]
        first = begin + np.arange(len(marked))
        start = at + owner[at]
        bounds = np.searchsorted(behind, np.arange(1, lengths.max() + 2))
        return Cuts(first, first + lengths, bounds, owner[at], start, start + size, piece)


def log_prefixes(cuts: Cuts, logs: np.ndarray) -> np.ndarray:
    """Log-probability of the characters before each place in each column of ``logs``, summed
    over all ways to cut them into pieces."""
    sums = np.zeros((int(cuts.last[-1]) + 1, logs.shape[1]))
    for a, b in pairwise(cuts.bounds):
        ways = sums[cuts.start[a:b]] + logs[cuts.piece[a:b]]
        ends = cuts.end[a:b]
        first = np.flatnonzero(np.diff(ends, prepend=-1))
        top = np.maximum.reduceat(ways, first)
        ways -= np.repeat(top, np.diff(first, append=b - a), axis=0)
        np.exp(ways, out=ways)
        sums[ends[first]] = top + np.log(np.add.reduceat(ways, first))
    return sums


def expected_counts(cuts: Cuts, logs: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """How often each piece is used on average over all segmentations of the words.

    Of the segmentations with a cut at a place, the share whose last piece before it is a
    given one follows from the prefix sums, so the cuts are dealt out from the words' ends.
    """
    sums = log_prefixes(cuts, logs[:, None])[:, 0]
    share = np.exp(sums[cuts.start] + logs[cuts.piece] - sums[cuts.end])
    cut = np.zeros(len(sums))
    cut[cuts.last] = uses
    for a, b in reversed(list(pairwise(cuts.bounds))):
        share[a:b] *= cut[cuts.end[a:b]]
        cut[cuts.start[a:b]] += share[a:b]  # pieces of one end have different starts
    return np.bincount(cuts.piece, share, len(logs))


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    logs: np.ndarray  # of probabilities by piece (the last: an unlisted character) and language

    def log_chances(self, lookup: Pieces, found: list[str]) -> np.ndarray:
        """Log-probability of each word in each language."""
        place = {word: i for i, word in enumerate(found)}
        total = np.zeros((len(found), len(self.languages)))
        for block in blocks(place):
            cuts = lookup.cuts(block)
            total[[place[word] for word in block]] = log_prefixes(cuts, self.logs)[cuts.last]
        return total


def train(rows: list[tuple[str, str]], pieces: list[str], rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language by expectation maximisation over its words."""
    languages = sorted({language for _, language in rows})
    lookup = Pieces(pieces)
    logs = np.zeros((len(pieces) + 1, len(languages)))
    for column, language in enumerate(languages):
        uses = Counter(
            word for text, own in rows if own == language for word in words(text))
        placed = [(lookup.cuts(block), np.array([uses[word] for word in block], float))
                  for block in blocks(uses)]
        for turn in range(rounds + 1):
            counts = np.full(len(pieces) + 1, 0.05)
            for cuts, times in placed:
                if turn:
                    counts += expected_counts(cuts, logs[:, column], times)
                else:  # to start with, how often a piece occurs anywhere
                    counts += np.bincount(cuts.piece, times[cuts.word], len(counts))
            counts[-1] = max(counts[-1], 0.5)
            logs[:, column] = np.log(counts / counts.sum())
    return Model(languages, pieces, logs)


def fit_languages(
    docs: DataFrame, vocabulary_path: str, usable: Column, per_language: int = PER_LANGUAGE
) -> Model:
    """Trains on at most ``per_language`` usable documents of each non-null ``lang``."""
    tagged = docs.select("doc_id", "lang")
    rows = sample(docs, tagged, "lang", usable, per_language, classes=None)
    return train(rows, vocabulary(vocabulary_path))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language of the whole text and its posterior
    probability, all languages being as likely beforehand.

    A null text and one without a letter get ``und`` with score 0, and so does every text if
    nothing was learned. Equal likelihoods go to the first language by name. Repeated rows
    give repeated results, an empty table an empty one; no column but ``doc_id`` and ``text``
    is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast({
        "languages": model.languages, "pieces": model.pieces, "logs": model.logs,
    })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        own = Model(state["languages"], state["pieces"], state["logs"])
        if "lookup" not in state:
            state["lookup"], state["known"] = Pieces(own.pieces), {}
            state["table"] = np.zeros((CACHE_BYTES // 8 // max(1, len(own.languages)),
                                       len(own.languages)))
            state["held"] = 0
        known, table = state["known"], state["table"]
        for batch in slices(batches):
            found = [words(text) for text in texts_of(batch, "text")]
            new = list(set().union(*found).difference(known))
            if len(known) + len(new) > len(table) or state["held"] > CACHE_BYTES:
                known.clear()
                state["held"] = 0
                new = list(set().union(*found))
                if len(new) > len(table):
                    table = state["table"] = np.zeros((len(new), len(own.languages)))
            first = len(known)
            table[first:first + len(new)] = own.log_chances(state["lookup"], new)
            known.update(zip(new, range(first, first + len(new)), strict=True))
            state["held"] += sum(map(len, new))
            names, scores = [], []
            for text in found:
                if not text or not own.languages:
                    names.append(NO_LANGUAGE)
                    scores.append(0.0)
                    continue
                at = np.fromiter(map(known.__getitem__, text), np.int64, len(text))
                total = table[at].sum(0)
                best = int(total.argmax())
                names.append(own.languages[best])
                scores.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
