"""Gradient-boosted trees for small tables, with calibrated probabilities. Training takes a bounded sample on the driver; the model is a
few kilobytes and is applied wherever the rows are."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Logistic boosting of trees of fixed depth over binned features, then an isotonic calibration on rows kept back for it."""

    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 16
    least_leaf: float = 1.0
    seed: int = 7
    edges: list[np.ndarray] = field(default_factory=list)
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0
    steps_x: np.ndarray | None = None
    steps_y: np.ndarray | None = None
    threshold: float = 0.5

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]).astype(np.int16) if len(x) else np.zeros((0, len(self.edges)), np.int16)

    def _cuts(self, values: np.ndarray) -> np.ndarray:
        """Between all values where they are few, else between quantiles."""
        own = np.unique(values)
        if len(own) > self.bins:
            own = np.unique(np.quantile(values, np.linspace(0, 1, self.bins + 1), method="nearest"))
        return (own[1:] + own[:-1]) / 2

    def _margin(self, b: np.ndarray) -> np.ndarray:
        f = np.full(len(b), self.base)
        for feature, cut, value in self.nodes:
            at = np.zeros(len(b), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (b[np.arange(len(b)), feature[at]] > cut[at])
            f += value[at - (2**self.depth - 1)]
        return f

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """x: rows of numbers; y: 0 or 1. Where y holds one class only, that class is always predicted."""
        x, y = np.asarray(x, float), np.asarray(y, float)
        order = np.random.default_rng(self.seed).permutation(len(y))
        held, used = order[: len(order) // 4], order[len(order) // 4 :]
        self.edges = [self._cuts(x[used, j]) for j in range(x.shape[1])]
        p = np.clip(y[used].mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        b, t = self._binned(x[used]), y[used]
        f, n_inner = np.full(len(t), self.base), 2**self.depth - 1
        for _ in range(self.trees):
            q = 1 / (1 + np.exp(-f))
            g, h = t - q, q * (1 - q)
            feature, cut = np.zeros(n_inner, np.int64), np.full(n_inner, 10**6, np.int64)
            at = np.zeros(len(t), np.int64)
            for node in range(n_inner):
                rows = np.flatnonzero(at == node)
                best = (1e-9, 0, 10**6)
                if len(rows) > 1:
                    gs, hs = g[rows], h[rows]
                    score = gs.sum() ** 2 / (hs.sum() + 1)
                    for j in range(b.shape[1]):
                        k = b[rows, j]
                        gb, hb = np.cumsum(np.bincount(k, gs, self.bins + 1)), np.cumsum(np.bincount(k, hs, self.bins + 1))
                        gain = gb**2 / (hb + 1) + (gb[-1] - gb) ** 2 / (hb[-1] - hb + 1) - score
                        gain[(hb < self.least_leaf / 4) | (hb[-1] - hb < self.least_leaf / 4)] = -1
                        c = int(gain.argmax())
                        if gain[c] > best[0]:
                            best = (float(gain[c]), j, c)
                feature[node], cut[node] = best[1], best[2]
                at[rows] = 2 * node + 1 + (b[rows, best[1]] > best[2])
            leaf = at - n_inner
            value = self.rate * np.bincount(leaf, g, n_inner + 1) / (np.bincount(leaf, h, n_inner + 1) + 1)
            self.nodes.append((feature, cut, value))
            f += value[leaf]
        self._calibrate(self._margin(self._binned(x[held])), y[held])
        return self

    def _calibrate(self, f: np.ndarray, y: np.ndarray) -> None:
        """Pools adjacent violators, then takes the threshold with the best F1 on the rows kept back (of equal ones the lowest cut in the
        middle of its gap)."""
        if not len(f) or y.min() == y.max():
            return
        order = np.argsort(f, kind="stable")
        blocks: list[list[float]] = []
        for v, t in zip(f[order], y[order], strict=True):
            blocks.append([v, t, 1.0])
            while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
                v2, t2, n2 = blocks.pop()
                v1, t1, n1 = blocks.pop()
                blocks.append([(v1 * n1 + v2 * n2) / (n1 + n2), (t1 * n1 + t2 * n2) / (n1 + n2), n1 + n2])
        self.steps_x, self.steps_y = np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])
        p = np.round(np.interp(f, self.steps_x, self.steps_y), 4)
        cuts = np.unique(p)
        f1 = [2 * ((p >= c) & (y == 1)).sum() / max(1, (p >= c).sum() + y.sum()) for c in cuts]
        k = int(np.argmax(f1))
        self.threshold = float((cuts[k] + (cuts[k - 1] if k else 0.0)) / 2)

    def probability(self, x: np.ndarray) -> np.ndarray:
        f = self._margin(self._binned(np.asarray(x, float)))
        return np.interp(f, self.steps_x, self.steps_y) if self.steps_x is not None else 1 / (1 + np.exp(-f))
