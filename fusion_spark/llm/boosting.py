"""Gradient-boosted trees for two classes over binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fusion_spark.llm.labels import sigmoid

DEPTH = 4
BINS = 32


@dataclass
class Trees:
    """Complete trees of ``DEPTH`` levels: a feature and a cut per inner node, a value per leaf."""

    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray
    leaves: np.ndarray  # trees x leaves
    start: float

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        place = np.arange(len(rows))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[place, features[node]] > cuts[node])
            total += leaves[node - len(cuts)]
        return total


def boost(
    rows: np.ndarray, truth: np.ndarray, trees: int = 40, rate: float = 0.3, ridge: float = 1.0
) -> Trees:
    """Fits each tree to the logistic loss's slope and bend, level by level over histograms."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS)[:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in
                       zip(cuts, rows.T, strict=True)], axis=1)
    share = np.clip(truth.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    inner = 2 ** DEPTH - 1
    all_features, all_cuts, all_leaves = [], [], []
    total = np.full(len(rows), start)
    for _ in range(trees):
        chance = sigmoid(total)
        slope, bend = truth - chance, np.maximum(chance * (1 - chance), 1e-6)
        features, places = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, count = 2 ** level - 1, 2 ** level
            gain = np.zeros(count)
            cut_bin = np.full(count, BINS + 1)
            for feature in range(rows.shape[1]):
                at = (node - first) * (BINS + 1) + binned[:, feature]
                size = count * (BINS + 1)
                up = np.bincount(at, slope, size).reshape(count, -1).cumsum(1)
                down = np.bincount(at, bend, size).reshape(count, -1).cumsum(1)
                left = up ** 2 / (down + ridge)
                right = (up[:, -1:] - up) ** 2 / (down[:, -1:] - down + ridge)
                better = left + right - up[:, -1:] ** 2 / (down[:, -1:] + ridge)
                best = better.argmax(1)
                value = better[np.arange(count), best]
                new = value > gain + 1e-9
                gain[new], cut_bin[new] = value[new], best[new]
                features[first:first + count][new] = feature
            for place in range(count):
                own = cuts[features[first + place]]
                if cut_bin[place] < len(own):
                    places[first + place] = own[cut_bin[place]]
            node = 2 * node + 1 + (
                binned[np.arange(len(rows)), features[node]] > cut_bin[node - first])
        leaf = node - inner
        value = rate * np.bincount(leaf, slope, inner + 1) / (
            np.bincount(leaf, bend, inner + 1) + ridge)
        total += value[leaf]
        all_features.append(features)
        all_cuts.append(places)
        all_leaves.append(value)
    return Trees(np.array(all_features), np.array(all_cuts), np.array(all_leaves), start)
