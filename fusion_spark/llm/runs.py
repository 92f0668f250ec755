"""Periodic runs of words: suffix-tree common extensions around Lyndon roots."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.words import slices, texts_of

LEAST = 12  # words of a run, at least
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixTree:
    """Ukkonen's suffix tree of ``symbols``, positive integers followed by one closing 0.

    ``tour`` lists the string depths along the Euler tour, ``first`` the place of each
    suffix's leaf in it. The depth of the lowest node between two leaves is the length of
    their suffixes' common prefix.
    """

    def __init__(self, symbols: list[int]):
        self.size = len(symbols)
        start, end, edges, width = self._grow(symbols)
        total = len(edges)
        keys = np.fromiter(edges.keys(), np.int64, total)
        self.child = np.fromiter(edges.values(), np.int64, total)
        edges.clear()
        self.parent, self.symbol = np.divmod(keys, width)
        self.span = np.array(end) - np.array(start)
        self.nodes = len(start)

    @staticmethod
    def _grow(symbols: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
        """Edges by parent * width + first symbol; an edge's label is [start, end) of its child."""
        width, size = max(symbols) + 1, len(symbols)
        start, end, link = [0], [0], [0]
        edges: dict[int, int] = {}
        node = length = waiting = edge = 0
        for place, symbol in enumerate(symbols):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = place
                key = node * width + symbols[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(place)
                    end.append(size)
                    link.append(0)
                    joint = node
                else:
                    label = min(end[child], place + 1) - start[child]
                    if length >= label:
                        edge, length, node = edge + label, length - label, child
                        continue
                    if symbols[start[child] + length] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    joint = len(start)
                    edges[key] = joint
                    edges[joint * width + symbol] = joint + 1
                    start += [start[child], place]
                    end += [start[child] + length, size]
                    link += [0, 0]
                    start[child] += length
                    edges[joint * width + symbols[start[child]]] = child
                if unlinked:
                    link[unlinked] = joint
                unlinked = joint
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length, edge = length - 1, place - waiting + 1
        return start, end, edges, width

    def _children(self, falling: bool) -> tuple[list[int], list[int]]:
        """Children of all nodes, by node and symbol, and where each node's begin.

        The closing symbol comes first also where symbols fall.
        """
        rank = np.where(self.symbol == 0, -self.nodes - self.size, -self.symbol) \
            if falling else self.symbol
        order = np.lexsort((rank, self.parent))
        begin = np.searchsorted(self.parent[order], np.arange(self.nodes + 1))
        return self.child[order].tolist(), begin.tolist()

    def walk(self) -> np.ndarray:
        """Makes the Euler tour; gives the rank of each suffix in rising order."""
        children, begin = self._children(falling=False)
        following, span = begin[:-1], self.span.tolist()
        depth, first, leaves = [0] * self.nodes, [0] * self.size, []
        tour, path = [0], [0]
        while path:
            node = path[-1]
            place = following[node]
            if place == begin[node + 1]:
                path.pop()
                if path:
                    tour.append(depth[path[-1]])
                continue
            following[node] = place + 1
            child = children[place]
            depth[child] = reached = depth[node] + span[child]
            if begin[child] == begin[child + 1]:
                first[self.size - reached] = len(tour)
                leaves.append(self.size - reached)
                tour += [reached, depth[node]]
            else:
                path.append(child)
                tour.append(reached)
        self.tour, self.first = np.array(tour, np.int32), np.array(first, np.int64)
        self.depth = depth
        return _ranks(leaves)

    def falling_ranks(self) -> np.ndarray:
        """Rank of each suffix where larger symbols come first, the end still before all."""
        children, begin = self._children(falling=True)
        leaves, stack = [], [0]
        while stack:
            node = stack.pop()
            if begin[node] == begin[node + 1]:
                leaves.append(self.size - self.depth[node])
            else:
                stack += children[begin[node]:begin[node + 1]][::-1]
        return _ranks(leaves)

    def common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes ``one`` and ``other``, two look-ups each.

        The table of range minima is made level by level, and each level answers the queries
        of its length, so one level is held at a time.
        """
        low = np.minimum(self.first[one], self.first[other])
        high = np.maximum(self.first[one], self.first[other])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        minima = self.tour
        for step in range(int(level.max(initial=-1)) + 1):
            asked = np.flatnonzero(level == step)
            out[asked] = np.minimum(minima[low[asked]], minima[high[asked] - (1 << step) + 1])
            minima = np.minimum(minima[:-(1 << step)], minima[1 << step:])
        return out


def _ranks(leaves: list[int]) -> np.ndarray:
    ranks = np.empty(len(leaves), np.int64)
    ranks[leaves] = np.arange(len(leaves))
    return ranks


def lyndon_ends(ranks: np.ndarray) -> np.ndarray:
    """End of the longest Lyndon word at each place: the next smaller suffix."""
    rank, ends, stack = ranks.tolist(), [0] * (len(ranks) - 1), []
    for place, own in enumerate(rank):
        while stack and rank[stack[-1]] > own:
            ends[stack.pop()] = place
        stack.append(place)
    return np.array(ends, np.int64)


def all_runs(symbols: np.ndarray) -> np.ndarray:
    """Every run of positive ``symbols`` as rows (start, length, period), in that order.

    Each run has, in one of the two orders of the symbols, a root that is the longest Lyndon
    word at its start, so extending those words both ways finds all runs and nothing else of
    twice its period.
    """
    size = len(symbols)
    if size < 2:
        return np.zeros((0, 3), np.int64)
    ahead = SuffixTree([*symbols.tolist(), 0])
    roots = [ahead.walk(), ahead.falling_ranks()]
    begin = np.tile(np.arange(size), 2)
    end = np.concatenate([lyndon_ends(ranks) for ranks in roots])
    right = ahead.common(begin, end)
    del ahead
    back = SuffixTree([*symbols[::-1].tolist(), 0])
    back.walk()
    left = back.common(size - begin, size - end)
    period = end - begin
    found = np.stack([begin - left, left + period + right, period], 1)
    return np.unique(found[found[:, 1] >= 2 * period], axis=0)


def recurring(codes: np.ndarray, size: int) -> np.ndarray:
    """True on the words that lie in a stretch of ``size`` words found again in the text.

    Stretches are compared by a 64-bit code; a collision only marks more words.
    """
    total = len(codes) - size + 1
    marks = np.zeros(len(codes) + 1, np.int64)
    if total < 2:
        return marks[:-1] > 0
    code = np.zeros(total, np.uint64)
    for step in range(size):
        code = code * np.uint64(0x9E3779B97F4A7C15) + codes[step:step + total].astype(np.uint64)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    again = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    marks[again] += 1
    marks[again + size] -= 1
    return np.cumsum(marks)[:-1] > 0


def word_runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """The runs of at least ``least`` words, by start, then period.

    A run of length n and period q, n at least 2q and ``least``, repeats its first n - q words
    q later, and these copies cover it. So it lies in a stretch of words that are all part of
    some recurring ``least / 2`` words, and what is outside such stretches needs no tree. The
    stretches of a text share one tree, parted by symbols of their own.
    """
    none = np.zeros((0, 3), np.int64)
    if len(words) < max(2, least):
        return none
    number = defaultdict(count(1).__next__)
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    marked = recurring(codes, max(1, (least + 1) // 2))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked, [0]])))
    begins, ends = edges[::2], edges[1::2]
    wide = ends - begins >= max(2, least)
    begins, ends = begins[wide], ends[wide]
    if not len(begins):
        return none
    parts, places = [], []
    for part, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
        parts += [codes[begin:end], [len(number) + 1 + part]]
        places += [np.arange(begin, end), [-1]]
    _, symbols = np.unique(np.concatenate(parts), return_inverse=True)
    runs = all_runs(symbols + 1)
    runs = runs[runs[:, 1] >= least]
    runs[:, 0] = np.concatenate(places)[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(marks)[:-1] == 0
    return b" ".join(words[place] for place in np.flatnonzero(keep).tolist())


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``.

    Words are what the white space of ASCII parts; null texts count as empty and have no
    words. ``runs`` lists (start, length, period) of every maximal stretch of at least
    ``least`` words and two periods, by start and period; ``collapsed`` is the text with every
    run cut to its first period. Repeated rows give repeated results, an empty table an empty
    one; only ``doc_id`` and ``text`` are read. A text is held whole in one task; its trees
    take about half a kilobyte for each word of its recurring stretches.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, flat, offsets, texts = [], [], [0], []
            for text in texts_of(batch, "text"):
                words = text.encode("utf-8", "surrogatepass").split()
                runs = word_runs(words, least)
                sizes.append(len(words))
                flat.append(runs)
                offsets.append(offsets[-1] + len(runs))
                texts.append(collapsed(words, runs))
            columns = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
            items = pa.StructArray.from_arrays(
                [pa.array(columns[:, place]) for place in range(3)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run,
        "doc_id long, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )
