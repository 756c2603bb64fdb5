"""Boosted trees from gradient histograms, in numpy: what one task does with the rows it holds.

A tree of depth D is an array of 2**(D+1) nodes; node i has the children 2i and 2i + 1, the
root is 1.  ``feature`` is -1 where a node is not split.  Rows are given as bins, the number of a
feature's edges below the value, so a split sends bins up to ``bin`` to the left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ..schemas import TreeSettings

#: Splits that gain less than this are not made.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class TreeRules:
    """Settings of a fit beside the tree settings: leaf penalty and the number of bins per feature (256 at most)."""

    settings: TreeSettings
    penalty: float = 1.0
    bins: int = 64

    @property
    def depth(self) -> int:
        return self.settings.max_depth

    @property
    def nodes(self) -> int:
        return 2 << self.depth


@dataclass
class Trees:
    """Trees of one series, a row for each."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def blank(cls, count: int, nodes: int) -> Trees:
        return cls(np.full((count, nodes), -1, dtype=np.int16), np.zeros((count, nodes), dtype=np.int16), np.zeros((count, nodes)))

    @classmethod
    def unpack(cls, feature: bytes, bin_: bytes, value: bytes, nodes: int) -> Trees:
        read = lambda data, kind: np.frombuffer(data, dtype=kind).reshape(-1, nodes).copy()
        return cls(read(feature, np.int16), read(bin_, np.int16), read(value, np.float64))

    def pack(self) -> tuple[bytes, bytes, bytes]:
        return self.feature.tobytes(), self.bin.tobytes(), self.value.tobytes()

    def __len__(self) -> int:
        return len(self.feature)

    def joined(self, other: Trees) -> Trees:
        return Trees(*[np.concatenate([getattr(self, k), getattr(other, k)]) for k in ("feature", "bin", "value")])

    def sums(self, bins: np.ndarray, upto: int | None = None) -> np.ndarray:
        """What the first ``upto`` trees add up to for each row."""
        trees = len(self) if upto is None else min(upto, len(self))
        if not trees:
            return np.zeros(len(bins))
        out = np.zeros(len(bins))
        step = max(1, (1 << 22) // max(1, len(bins)))
        for lo in range(0, trees, step):
            tree = np.arange(lo, min(lo + step, trees))[:, None]
            node = np.ones((len(tree), len(bins)), dtype=np.int64)
            while True:
                feature = self.feature[tree, node]
                inner = feature >= 0
                if not inner.any():
                    break
                right = bins[np.arange(len(bins))[None, :], np.maximum(feature, 0)] > self.bin[tree, node]
                node = np.where(inner, 2 * node + right, node)
            out += self.value[tree, node].sum(0)
        return out


def bins_of(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin of every value; ``edges``: a sorted row per feature, filled up with infinity."""
    out = np.empty(x.shape, dtype=np.uint8)
    for f in range(x.shape[1]):
        out[:, f] = np.searchsorted(edges[f], x[:, f], side="left")
    return out


def sampled(at: np.ndarray, tree: int, rules: TreeRules) -> np.ndarray:
    """Rows that a tree learns from, by a hash of their time; the same wherever a row lies."""
    share = rules.settings.subsample
    if share >= 1:
        return np.ones(len(at), dtype=bool)
    h = at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((rules.settings.seed * 1_000_003 + tree) % (1 << 63))
    for _ in range(2):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share


def columns_of(count: int, tree: int, rules: TreeRules) -> np.ndarray:
    """Features that a tree may split on."""
    share = rules.settings.colsample_bytree
    allowed = np.zeros(count, dtype=bool)
    kept = max(1, int(round(share * count)))
    allowed[np.random.default_rng([rules.settings.seed, tree]).permutation(count)[:kept]] = True
    return allowed


def histogram(bins: np.ndarray, place: np.ndarray, gradient: np.ndarray, width: int, n_bins: int) -> np.ndarray:
    """Sums of gradients and rows per (node of the level, feature, bin); rows with a negative place are left out.

    Histograms of parts of the rows add up to that of all.
    """
    own = place >= 0
    bins, place, gradient = bins[own], place[own], gradient[own]
    features = bins.shape[1]
    cell = (place[:, None] * features + np.arange(features)) * n_bins + bins
    size = width * features * n_bins
    total = np.bincount(cell.ravel(), weights=np.repeat(gradient, features), minlength=size)
    rows = np.bincount(cell.ravel(), minlength=size)
    return np.stack([total, rows], axis=-1).reshape(width, features, n_bins, 2)


def split_level(trees: Trees, tree: int, level: int, sums: np.ndarray, allowed: np.ndarray, rules: TreeRules) -> bool:
    """Split the nodes of a level by second-order gain and set the values below; true if any node was split.

    The gain of a split is half of GL²/(HL+penalty) + GR²/(HR+penalty) - G²/(H+penalty).
    Equal gains go to the first feature, then to the lowest bin.
    """
    width, weight, rate = 1 << level, max(rules.settings.min_child_weight, 1), rules.settings.learning_rate
    value = lambda g, h: -rate * g / (h + rules.penalty)
    score = lambda g, h: g * g / (h + rules.penalty)
    left = np.cumsum(sums, axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left
    g, h = whole[:, 0, 0, 0], whole[:, 0, 0, 1]
    if level == 0:
        trees.value[tree, 1] = value(g[0], h[0]) if h[0] else 0.0
    gain = (score(left[..., 0], left[..., 1]) + score(right[..., 0], right[..., 1]) - score(g, h)[:, None, None]) / 2
    fits = (left[..., 1] >= weight) & (right[..., 1] >= weight) & allowed[None, :, None]
    flat = np.where(fits, gain, -np.inf).reshape(width, -1)
    best = flat.argmax(1)
    found = np.flatnonzero(flat[np.arange(width), best] > LEAST_GAIN)
    for i in found.tolist():
        f, b = divmod(int(best[i]), sums.shape[2])
        node = width + i
        trees.feature[tree, node], trees.bin[tree, node] = f, b
        for side, part in ((0, left), (1, right)):
            trees.value[tree, 2 * node + side] = value(part[i, f, b, 0], part[i, f, b, 1])
    return len(found) > 0


def advanced(trees: Trees, tree: int, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Where rows stand one level further down."""
    feature = trees.feature[tree, node]
    right = bins[np.arange(len(bins)), np.maximum(feature, 0)] > trees.bin[tree, node]
    return np.where(feature >= 0, 2 * node + right, node)


def grow(bins: np.ndarray, y: np.ndarray, at: np.ndarray, base: float, rules: TreeRules) -> Trees:
    """All trees of a series whose rows are at hand."""
    trees = Trees.blank(rules.settings.n_estimators, rules.nodes)
    predicted = np.full(len(y), base)
    for t in range(len(trees)):
        used, allowed = sampled(at, t, rules), columns_of(bins.shape[1], t, rules)
        node, gradient = np.ones(len(y), dtype=np.int64), predicted - y
        for level in range(rules.depth):
            width = 1 << level
            sums = histogram(bins, np.where(used, node - width, -1), gradient, width, rules.bins)
            if not split_level(trees, t, level, sums, allowed, rules):
                break
            node = advanced(trees, t, bins, node)
        predicted += trees.value[t, node]
    return trees
