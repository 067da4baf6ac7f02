"""Sparse linear models on hashed features: follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Rows of sparse features: ``index`` and ``value`` of row i lie in ``first[i]:first[i + 1]``."""

    first: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Sparse dot product of every row with the weights."""
        total = np.concatenate([[0.0], np.cumsum(weights[self.index].astype(np.float64) * self.value)])
        return total[self.first[1:]] - total[self.first[:-1]]


@dataclass
class Ftrl:
    """Per-coordinate learning rates with L1 and L2 terms; one pass updates row by row."""

    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 1.0
    epochs: int = 3

    def fit(self, rows: Rows, labels: np.ndarray, dim: int, dense: np.ndarray | None = None) -> np.ndarray:
        """Weights of ``dim`` hashed features, then of the dense columns, then the bias."""
        extra = np.zeros((len(rows), 0)) if dense is None else dense
        size = dim + extra.shape[1] + 1
        z, n = np.zeros(size), np.zeros(size)
        tail = np.arange(dim, size)
        for _ in range(self.epochs):
            for r in range(len(rows)):
                part = slice(rows.first[r], rows.first[r + 1])
                ix = np.concatenate([rows.index[part], tail])
                x = np.concatenate([rows.value[part], extra[r], [1.0]])
                w = self._weights(z[ix], n[ix])
                w[-1] = -z[-1] / ((self.beta + np.sqrt(n[-1])) / self.alpha)
                g = (sigmoid(float(w @ x)) - labels[r]) * x
                grown = n[ix] + g * g
                z[ix] += g - (np.sqrt(grown) - np.sqrt(n[ix])) / self.alpha * w
                n[ix] = grown
        out = self._weights(z, n)
        out[-1] = -z[-1] / ((self.beta + np.sqrt(n[-1])) / self.alpha)
        return out

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(
            np.abs(z) <= self.l1,
            0.0,
            -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2),
        )


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def predict(rows: Rows, weights: np.ndarray, dim: int, dense: np.ndarray | None = None) -> np.ndarray:
    total = rows.dot(weights[:dim]) + weights[-1]
    if dense is not None and dense.shape[1]:
        total = total + dense @ weights[dim : dim + dense.shape[1]]
    return sigmoid(total)


def join_rows(firsts: Sequence[np.ndarray], index: Sequence[np.ndarray], value: Sequence[np.ndarray]) -> Rows:
    sizes = np.concatenate([np.diff(f) for f in firsts]) if firsts else np.zeros(0, np.int64)
    return Rows(
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        np.concatenate(index) if index else np.zeros(0, np.int64),
        np.concatenate(value) if value else np.zeros(0),
    )
