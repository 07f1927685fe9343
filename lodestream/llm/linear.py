"""Sparse linear models in numpy, fitted on the driver from bounded samples and applied in workers.

:class:`Rows` holds rows of different lengths one after the other: feature numbers, values and where each row
starts. Weights are (dim + 1, labels); the last feature is padding, its weight stays 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rows:
    """No row may be empty."""

    idx: np.ndarray
    val: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.starts, len(self.idx)))

    def take(self, chosen: np.ndarray) -> Rows:
        """The rows of a mask."""
        sizes = self.sizes
        keep = np.repeat(chosen, sizes)
        own = sizes[chosen]
        return Rows(self.idx[keep], self.val[keep], np.cumsum(own) - own)

    def and_(self, other: Rows) -> Rows:
        return joined([self, other])


def joined(parts: list[Rows]) -> Rows:
    """All rows, one part after the other."""
    before = np.cumsum([0] + [len(p.idx) for p in parts])
    return Rows(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("idx", "val")), np.concatenate([p.starts + b for p, b in zip(parts, before)]))


def rows(lists: list, dim: int) -> Rows:
    """Rows of ones from lists of feature numbers."""
    sizes = np.array([max(1, len(x)) for x in lists], np.int64)
    idx = np.fromiter((i for x in lists for i in (x if len(x) else (dim,))), np.int32, int(sizes.sum()))
    return Rows(idx, np.ones(len(idx), np.float32), np.cumsum(sizes) - sizes)


def from_triples(row: np.ndarray, idx: np.ndarray, val: np.ndarray, n: int) -> Rows:
    """Rows from (row, feature, value) in any order; each of the n rows occurs."""
    o = np.argsort(row, kind="stable")
    sizes = np.bincount(row, minlength=n)
    return Rows(idx[o].astype(np.int32), val[o].astype(np.float32), np.cumsum(sizes) - sizes)


def scores(W: np.ndarray, x: Rows) -> np.ndarray:
    """(rows, labels) of W (dim + 1, labels)."""
    if not len(x):
        return np.zeros((0, W.shape[1]), np.float32)
    return np.stack([np.add.reduceat(np.take(np.ascontiguousarray(W[:, k]), x.idx) * x.val, x.starts) for k in range(W.shape[1])], 1)


def fit(x: Rows, Y: np.ndarray, dim: int, *, epochs: int = 80, rate: float = 0.2, l2: float = 1e-4, weight: np.ndarray | None = None, start: np.ndarray | None = None) -> np.ndarray:
    """Logistic regressions, one for each column of Y (values in [0, 1]), by full-batch Adam, from ``start`` if
    given. The gradient is summed by features in their own order, which is sorted once."""
    n, L = Y.shape
    W = np.zeros((dim + 1, L), np.float32) if start is None else start.copy()
    m, s = np.zeros_like(W), np.zeros_like(W)
    w = np.ones((n, 1), np.float32) if weight is None else weight.reshape(n, -1).astype(np.float32)
    w = w / np.maximum(w.sum(0), 1e-9)
    o = np.argsort(x.idx, kind="stable")
    by = x.idx[o]
    begin = np.flatnonzero(np.r_[True, by[1:] != by[:-1]]) if len(by) else np.zeros(0, np.int64)
    features = by[begin]
    of_row, of_val = np.repeat(np.arange(n, dtype=np.int32), x.sizes)[o], x.val[o]
    for t in range(1, epochs + 1):
        g = (1 / (1 + np.exp(-np.clip(scores(W, x), -30, 30))) - Y) * w
        G = l2 * W
        for k in range(L):
            G[features, k] += np.add.reduceat(np.take(np.ascontiguousarray(g[:, k], dtype=np.float32), of_row) * of_val, begin)
        G[dim] = 0
        m = 0.9 * m + 0.1 * G
        s = 0.999 * s + 0.001 * G * G
        W -= (rate / (1 - 0.9**t)) * m / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    W[dim] = 0
    return W


def best_threshold(score: np.ndarray, truth: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The score above which F1 on held-out rows is best; +inf without positives."""
    w = np.ones(len(score)) if weight is None else weight
    if not truth.any():
        return float("inf")
    o = np.argsort(-score, kind="stable")
    tp = np.cumsum(truth[o] * w[o])
    seen = np.cumsum(w[o])
    f1 = 2 * tp / (seen + tp[-1])
    at = int(np.argmax(f1))
    low = score[o][at + 1] if at + 1 < len(o) else score[o][at] - 1
    return float((score[o][at] + low) / 2)
