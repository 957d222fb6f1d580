"""Histogram gradient-boosted trees in numpy, flattened into arrays.

Values are put into bins once. A tree grows level by level from sums of gradients
per node, input and bin. Its nodes are the entries of flat arrays, so that many
rows walk down a tree together.
"""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Entry ``i`` of a tree goes to ``2 i + 1`` if its input is at most the threshold, else to ``2 i + 2``."""

    prior: float
    depth: int
    inputs: np.ndarray
    thresholds: np.ndarray
    values: np.ndarray

    def margins(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.prior)
        every = np.arange(len(rows))
        for inputs, thresholds, values in zip(self.inputs, self.thresholds, self.values):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (rows[every, inputs[at]] > thresholds[at])
            total += values[at]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(rows)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Values between which the bins of a column lie, at most ``bins - 1``."""
    known = np.unique(column)
    if len(known) <= bins:
        return (known[1:] + known[:-1]) / 2
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def fit_trees(
    rows: np.ndarray,
    labels: np.ndarray,
    rounds: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    least_weight: float = 5.0,
    smooth: float = 1.0,
) -> Trees:
    """Trees for the probability that a label is 1. Without rows, or with one label only, the prior is all there is."""
    n, width = rows.shape
    nodes = 2 ** (depth + 1) - 1
    share = (labels.sum() + 1) / (n + 2)
    prior = float(np.log(share / (1 - share)))
    if n == 0 or labels.min() == labels.max():
        empty = np.zeros((0, nodes))
        return Trees(prior, depth, empty.astype(np.int64), empty, empty)
    edges = [_edges(rows[:, j], bins) for j in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, j], "left") for j, e in enumerate(edges)], axis=1)
    margin = np.full(n, prior)
    kept = ([], [], [])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-margin))
        slope, weight = labels - chance, chance * (1 - chance)
        inputs, thresholds, values = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            best = np.full(wide, 1e-6)
            split_bin = np.full(wide, bins)
            cells = (at - first) * bins
            for j in range(width):
                g, h = (np.bincount(cells + binned[:, j], w, wide * bins).reshape(wide, bins).cumsum(axis=1) for w in (slope, weight))
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + smooth) + (g_all - g) ** 2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
                gain[(h < least_weight) | (h_all - h < least_weight)] = 0
                gain[:, len(edges[j]) :] = 0
                place = gain.argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(wide), place] > best)
                best[better] = gain[better, place[better]]
                inputs[first + better] = j
                split_bin[better] = place[better]
                if len(better):
                    thresholds[first + better] = edges[j][place[better]]
            own = inputs[at]
            at = 2 * at + 1 + (binned[np.arange(n), own] > split_bin[at - first])
        first = 2**depth - 1
        g, h = (np.bincount(at - first, w, 2**depth) for w in (slope, weight))
        values[first:] = rate * g / (h + smooth)
        margin += values[at]
        for held, made in zip(kept, (inputs, thresholds, values)):
            held.append(made)
    return Trees(prior, depth, *(np.stack(k) for k in kept))
