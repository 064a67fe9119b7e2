"""Logistic regression over sparse rows, in numpy."""

from __future__ import annotations

import numpy as np


#: Entries whose values are gathered at a time.
AT_ONCE = 1 << 18


class SparseRows:
    """Rows as lists of feature numbers, each feature there or not, plus a few dense columns."""

    def __init__(self, rows: list, features: int, dense: np.ndarray | None = None):
        sizes = np.fromiter(map(len, rows), np.int32, len(rows))
        entries = np.concatenate([np.asarray(row, np.int32) for row in rows] or [np.zeros(0, np.int32)])
        self._set(sizes, entries, features, dense)

    @classmethod
    def flat(cls, sizes: np.ndarray, entries: np.ndarray, features: int) -> "SparseRows":
        """From the number of entries of each row, and all rows' entries one after the other."""
        out = cls.__new__(cls)
        out._set(sizes.astype(np.int32, copy=False), entries.astype(np.int32, copy=False), features, None)
        return out

    def _set(self, sizes: np.ndarray, entries: np.ndarray, features: int, dense: np.ndarray | None) -> None:
        self.number, self.features, self.sizes, self.feature = len(sizes), features, sizes, entries
        # The entries again, feature by feature, so that both ways sums run over neighbours.
        rows = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.row = rows[np.argsort(entries, kind="stable")]
        self.times = np.bincount(entries, minlength=features).astype(np.int32)
        self.dense = np.zeros((len(sizes), 0)) if dense is None else dense

    def with_dense(self, columns: list[np.ndarray]) -> "SparseRows":
        out = SparseRows.__new__(SparseRows)
        out.__dict__.update(self.__dict__)
        out.dense = np.column_stack(columns) if columns else np.zeros((self.number, 0))
        return out

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Weights are those of the features, of the dense columns and the intercept, in that order."""
        sums = _sums(weights, self.feature, self.sizes)
        return sums + self.dense @ weights[self.features:-1] + weights[-1]

    def gradient(self, errors: np.ndarray) -> np.ndarray:
        sparse = _sums(errors, self.row, self.times)
        return np.concatenate((sparse, self.dense.T @ errors, [errors.sum()]))


def _sums(values: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the values at the places, in runs of these sizes, so many places at a time."""
    out, filled = np.zeros(len(sizes)), np.flatnonzero(sizes)
    ends = np.cumsum(sizes[filled], dtype=np.int64)
    first = done = 0
    while first < len(filled):
        last = max(int(np.searchsorted(ends, done + AT_ONCE, "right")), first + 1)
        starts = ends[first:last] - sizes[filled[first:last]] - done
        out[filled[first:last]] = np.add.reduceat(values[at[done:ends[last - 1]]], starts)
        first, done = last, int(ends[last - 1])
    return out


def sigmoid(scores: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scores, -50, 50)))


def logit(shares: np.ndarray) -> np.ndarray:
    shares = np.clip(shares, 1e-6, 1 - 1e-6)
    return np.log(shares / (1 - shares))


def fit(
    rows: SparseRows, labels: np.ndarray, counts: np.ndarray | None = None,
    ridge: float = 1e-4, steps: int = 400, close: float = 1e-6,
) -> np.ndarray:
    """Weights of least mean logistic loss plus ridge, by accelerated gradient steps.

    They end when no slope is as steep as ``close``, or after so many.
    Steps are scaled by the curvature of each weight, bounded by how often its feature occurs.
    With labels of one kind only the intercept is fitted, to a probability short of certainty;
    without labels it is that of never.
    """
    counts = np.ones(rows.number) if counts is None else counts
    size = rows.features + rows.dense.shape[1] + 1
    total = counts.sum()
    weights = np.zeros(size)
    mean = (counts * labels).sum() / total if total else 0.0
    weights[-1] = logit(np.array([(mean * total + 0.5) / (total + 1) if total else 0.0]))[0]
    if not total or mean in (0.0, 1.0):
        return weights
    # Diagonal bound of the Hessian: each row's curvature spread over its entries.
    entries = rows.sizes + np.abs(rows.dense).sum(axis=1) + 1
    spread = counts * entries / 4 / total
    scale = rows.with_dense([np.abs(column) for column in rows.dense.T]).gradient(spread) + ridge
    ahead, before, pace = weights.copy(), weights, 1.0
    pull = np.full(size, ridge)
    pull[-1] = 0.0
    for _ in range(steps):
        errors = counts * (sigmoid(rows.scores(ahead)) - labels) / total
        slope = rows.gradient(errors) + pull * ahead
        weights = ahead - slope / scale
        if np.abs(slope).max() < close:
            break
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = weights + (pace - 1) / faster * (weights - before)
        before, pace = weights, faster
    return weights
