"""Histogram gradient-boosted trees in numpy: fit on a bounded sample, score by array traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """All trees as flat arrays: node ``i`` of tree ``t`` is entry ``roots[t] + i``.

    ``feature`` is -1 in leaves; ``left`` is the entry of the left child, the
    right one follows it. A row goes left if its value <= ``cut``.
    """

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.where(inner, f, 0)] > self.cut[at]
                at = np.where(inner, self.left[at] + right, at)
            out += self.value[at]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, least_rows: int = 20, ridge: float = 1.0,
) -> Trees:
    """Logistic loss, second order, quantile bins. One class only (or no rows) gives a constant score."""
    n, width = x.shape
    share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if n else 0.5
    base = float(np.log(share / (1 - share)))
    feature, cut, left, value, roots = [], [], [], [], []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
        code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        raw = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            roots.append(len(feature))
            todo = [(len(feature), np.arange(n), 0)]
            feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
            while todo:
                at, rows, level = todo.pop()
                gs, hs = g[rows].sum(), h[rows].sum()
                best = (1e-6, -1, 0)
                if level < depth and len(rows) >= 2 * least_rows:
                    for j in range(width):
                        c = code[rows, j]
                        size = len(edges[j]) + 1
                        gl = np.cumsum(np.bincount(c, g[rows], size))[:-1]
                        hl = np.cumsum(np.bincount(c, h[rows], size))[:-1]
                        nl = np.cumsum(np.bincount(c, minlength=size))[:-1]
                        if not len(gl):
                            continue
                        gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                        gain[(nl < least_rows) | (len(rows) - nl < least_rows)] = -1
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], j, k)
                if best[1] < 0:
                    value[at] = float(-rate * gs / (hs + ridge))
                    raw[rows] += value[at]
                    continue
                _, j, k = best
                feature[at], cut[at], left[at] = j, float(edges[j][k]), len(feature)
                low = code[rows, j] <= k
                for part in (rows[low], rows[~low]):
                    todo.append((len(feature), part, level + 1))
                    feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
    as_ints = lambda v: np.array(v, np.int64)
    return Trees(base, as_ints(roots), as_ints(feature), np.array(cut), as_ints(left), np.array(value))
