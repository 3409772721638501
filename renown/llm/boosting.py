"""Gradient boosted trees on small whole numbers, with calibrated probabilities.

Features are 0 to 31, so that the best cut of a node comes from histograms. ``fit_trees`` takes rows
in memory, ``grow_trees`` a table of any size: every level of a tree is one pass in which tasks add up their rows'
histograms, and the driver gets one sum per core, node, feature and value. Sums are of whole numbers, so
nothing hangs on how the table is cut. Scoring is a few numpy passes over any number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BINS = 32
#: Gradients are added up in whole multiples of its inverse.
UNIT = float(1 << 30)


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: per tree, feature and cut of inner nodes, value of leaves."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of rows of features."""
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return total


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _best_cuts(x, node, nodes, gradient, hessian, penalty):
    """Feature and cut of the largest gain, for each of ``nodes`` nodes."""
    key = [node * BINS + x[:, f] for f in range(x.shape[1])]
    g, h = (
        np.stack([np.bincount(k, w, nodes * BINS).reshape(nodes, BINS) for k in key], axis=1) for w in (gradient, hessian)
    )
    return _best_of(g.cumsum(axis=2), h.cumsum(axis=2), penalty)


def _best_of(g: np.ndarray, h: np.ndarray, penalty: float):
    """Feature and cut of the largest gain, per node of running sums by node, feature and value."""
    left = g**2 / (h + penalty)
    right = (g[:, :, -1:] - g) ** 2 / (h[:, :, -1:] - h + penalty)
    best = (left + right).reshape(len(g), -1).argmax(axis=1)
    return best // BINS, best % BINS


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, penalty: float = 1.0
) -> Trees:
    """Trees on the gradient of the logistic loss."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    features = np.zeros((trees, inner), np.int64)
    cuts = np.zeros((trees, inner), np.int64)
    values = np.zeros((trees, inner + 1))
    margin = np.full(len(x), base)
    for t in range(trees):
        p = _sigmoid(margin)
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            f, c = _best_cuts(x, node, nodes, gradient, hessian, penalty)
            features[t, first : first + nodes], cuts[t, first : first + nodes] = f, c
            node = 2 * node + (x[np.arange(len(x)), f[node]] > c[node])
        g = np.bincount(node, gradient, inner + 1)
        h = np.bincount(node, hessian, inner + 1)
        values[t] = rate * g / (h + penalty)
        margin += values[t][node]
    return Trees(features, cuts, values, base)


@dataclass
class _Growing:
    """The trees of one group so far, and the cuts of the next one by level."""

    done: Trees
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def node(self, x: np.ndarray) -> np.ndarray:
        """Where rows of features stand in the tree that grows, counted within its last level."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for f, c in self.levels:
            node = 2 * node + (x[rows, f[node]] > c[node])
        return node

    def add(self, g: np.ndarray, h: np.ndarray, depth: int, rate: float, penalty: float) -> None:
        """The next level from the sums of gradients, and after the last one the tree with its leaves."""
        g, h = g.cumsum(axis=2), h.cumsum(axis=2)
        f, c = _best_of(g, h, penalty)
        self.levels.append((f, c))
        if len(self.levels) < depth:
            return
        at = np.arange(len(f))
        left, right = (
            rate * a / (b + penalty)
            for a, b in ((g[at, f, c], h[at, f, c]), (g[at, f, -1] - g[at, f, c], h[at, f, -1] - h[at, f, c]))
        )
        old, tree = self.done, (np.concatenate(x) for x in zip(*self.levels))
        features, cuts = tree
        self.done = Trees(
            np.vstack([old.feature, features]),
            np.vstack([old.cut, cuts]),
            np.vstack([old.value, np.column_stack([left, right]).ravel()]),
            old.base,
        )
        self.levels = []


def grow_trees(
    rows: DataFrame,
    shares: Mapping[int, float],
    features: int,
    trees: int = 40,
    depth: int = 4,
    rate: float = 0.3,
    penalty: float = 1.0,
) -> dict[int, Trees]:
    """``fit_trees`` for every group of a stored table ``kind, x, yes, n``, all groups in the same passes.

    A row stands for ``n`` equal rows of ``features`` bytes ``x``, ``yes`` of which are right; ``shares`` has the share of right
    rows of each group to learn.
    """
    inner = (1 << depth) - 1
    growing = {}
    for kind, share in shares.items():
        share = float(np.clip(share, 1e-3, 1 - 1e-3))
        none = np.zeros((0, inner), np.int64)
        growing[kind] = _Growing(Trees(none, none, np.zeros((0, inner + 1)), float(np.log(share / (1 - share)))))
    context = rows.sparkSession.sparkContext
    few = rows.select("kind", "x", "yes", "n").coalesce(context.defaultParallelism)  # so many sums reach the driver at once
    for turn in range(trees * depth if growing else 0):
        nodes = 1 << turn % depth
        cells = nodes * features * BINS
        shared = context.broadcast(growing)

        def run(batches):
            sums = {kind: np.zeros((2, cells), np.int64) for kind in shared.value}
            for batch in batches:
                kinds, yes, n = (batch.column(k).to_numpy() for k in (0, 2, 3))
                every = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, features)
                for kind, group in shared.value.items():
                    pick = np.flatnonzero(kinds == kind)
                    if not len(pick):
                        continue
                    x = every[pick].astype(np.int64)
                    p = _sigmoid(group.done.margin(x))
                    cell = ((group.node(x)[:, None] * features + np.arange(features)) * BINS + x).ravel()
                    for k, each in enumerate((yes[pick] - n[pick] * p, n[pick] * p * (1 - p))):
                        whole = np.repeat(np.round(each * UNIT), features)
                        sums[kind][k] += np.bincount(cell, whole, cells).astype(np.int64)
            packed = np.stack(list(sums.values())).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["sums"])

        found = few.mapInArrow(run, "sums binary").toArrow().column(0).to_pylist()
        total = sum(np.frombuffer(one, np.int64).reshape(len(growing), 2, nodes, features, BINS) for one in found) / UNIT
        for group, both in zip(growing.values(), total):
            group.add(*both, depth, rate, penalty)
        shared.unpersist()
    return {kind: group.done for kind, group in growing.items()}


@dataclass(frozen=True)
class Calibration:
    """Probability of a margin: sigmoid of ``slope * margin + offset``."""

    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margin + self.offset)


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 50, times: np.ndarray | None = None) -> Calibration:
    """Logistic regression on the margins of rows the trees have not seen; a row may stand for ``times`` equal ones.

    Smoothed targets and a slope drawn towards 1 keep it finite where the margins separate the rows.
    """
    times = np.ones(len(y)) if times is None else times
    yes, no = (times * y).sum(), (times * (1 - y)).sum()
    target = np.where(y > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = _sigmoid(a * margin + b)
        w, d = times * (p * (1 - p) + 1e-9), times * (p - target)
        g = np.array([(d * margin).sum() + a - 1, d.sum() + b / 100])
        h = np.array([[(w * margin**2).sum() + 1, (w * margin).sum()], [(w * margin).sum(), w.sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -0.5, 0.5)
        a, b = a - step[0], b - step[1]
    return Calibration(float(a), float(b))


def threshold_for(
    probability: np.ndarray, y: np.ndarray, precision: float, least: int, times: np.ndarray | None = None
) -> float:
    """The lowest probability from which on ``precision`` is held; above 1 if it is held by fewer than ``least`` rows.

    A row may stand for ``times`` equal ones.
    """
    times = np.ones(len(y)) if times is None else times
    order = np.argsort(-probability, kind="stable")
    right = np.cumsum((times * y)[order])
    taken = np.cumsum(times[order])
    last_of_value = np.append(np.diff(probability[order]) != 0, True)
    good = np.flatnonzero((right / taken >= precision) & (right >= least) & last_of_value)
    return float(probability[order][good[-1]]) if len(good) else 2.0
