"""Follow-the-regularised-leader with elastic net over sparse rows, on the driver.

Only a bounded sample is ever fitted here; its bound is a parameter of the
operators that use this.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Rows:
    """Sparse rows: flat feature numbers and values with row offsets."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray]):
        self.offsets = np.concatenate(([0], np.cumsum([len(f) for f in features]))).astype(np.int64)
        self.features = np.concatenate(features or [np.zeros(0, np.int32)]).astype(np.int32)
        self.values = np.concatenate(values or [np.zeros(0)]).astype(np.float32)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def batch(self, rows: np.ndarray, more: Rows | None = None) -> Batch:
        """These rows, and after them all of ``more``."""
        size = self.offsets[rows + 1] - self.offsets[rows]
        ends = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(self.offsets[rows] - ends[:-1], size) + np.arange(ends[-1])
        parts = [(self.features[at], self.values[at], np.repeat(np.arange(len(rows)), size))]
        n = len(rows)
        if more is not None and len(more):
            parts.append((more.features, more.values, np.repeat(np.arange(n, n + len(more)), np.diff(more.offsets))))
            n += len(more)
        return Batch(*(np.concatenate(c) for c in zip(*parts, strict=True)), n)


class Batch:
    """Some sparse rows over the features that they use: products without a dense matrix."""

    def __init__(self, features: np.ndarray, values: np.ndarray, row: np.ndarray, n: int):
        mark = np.zeros(int(features.max(initial=-1)) + 1, dtype=bool)
        mark[features] = True
        self.used = np.flatnonzero(mark)
        place = np.cumsum(mark) - 1
        self.at, self.values, self.row, self.n = place[features], values.astype(np.float64), row, n

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Rows times weights (of the used features; one column per class)."""
        return np.stack([np.bincount(self.row, weights=self.values * w[self.at], minlength=self.n) for w in weights.T], axis=1)

    def gradient(self, error: np.ndarray) -> np.ndarray:
        """Transposed rows times an error per row (one column per class)."""
        return np.stack([np.bincount(self.at, weights=self.values * e[self.row], minlength=len(self.used)) for e in error.T], axis=1)


class Ftrl:
    """Per-coordinate learning rates, L1 and L2; weights are made from the state when read."""

    def __init__(self, features: int, classes: int, alpha: float, beta: float, l1: float, l2: float):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows: np.ndarray | slice = slice(None), l1: float | None = None) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        l1 = self.l1 if l1 is None else l1
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / rate, 0.0)

    def step(self, rows: np.ndarray, weights: np.ndarray, gradient: np.ndarray) -> None:
        n = self.n[rows]
        sigma = (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha
        self.z[rows] += gradient - sigma * weights
        self.n[rows] = n + gradient**2


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of logits that minimises the negative log-likelihood of held-back rows."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20.0), 120))

    def loss(t: float) -> float:
        p = softmax(logits / t)[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    return float(min(grid, key=loss))


def smallest_by_hash(rows: DataFrame, group: str, sizes: dict, most: int, *order: Column) -> DataFrame:
    """Up to ``most`` rows of each group, those first in ``order``, whose first column is a 64-bit hash ``h``.

    ``sizes`` has the number of rows of each group.  Hashes are uniform, so a
    bound on them leaves a few more than ``most`` rows of a large group; only
    these are sent to be ranked, however large the group.
    """
    share = (most + 10 * most**0.5 + 20) / F.greatest(F.lit(1), F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, n)]), F.col(group)), F.lit(1))) if sizes else F.lit(1.0)
    few = rows.where((F.col("h").cast("double") / 2.0**64 + 0.5) < share)
    rank = F.row_number().over(Window.partitionBy(group).orderBy("h", *order))
    return few.withColumn("rank", rank).where(F.col("rank") <= most)
