"""A linear model over hashed features, fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rows:
    """Sparse rows: row number, column and value of each entry."""

    n: int
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, features: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        """From (columns, values) of each row."""
        lengths = [len(c) for c, _ in features]
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return cls(len(features), np.repeat(np.arange(len(features)), lengths), join([c for c, _ in features], np.int64), join([v for _, v in features], np.float64))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(rows: Rows, target: np.ndarray, weight: np.ndarray, columns: int, pairs: Rows | None = None, pair_weight: np.ndarray | None = None, l2: float = 1e-5, steps: int = 300, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model, by AdaGrad on all rows at once. target: 0 to 1.

    pairs: differences of features between two versions of a text whose scores should be equal; the square of each one's
    change of score is added to the loss, by pair_weight. No rows: all weights 0.
    """
    w, b = np.zeros(columns), 0.0
    if not rows.n:
        return w, b
    total = max(weight.sum(), 1e-9)
    base = float(np.clip((weight * target).sum() / total, 1e-3, 1 - 1e-3))
    b = float(np.log(base / (1 - base)))
    g2, gb2 = np.full(columns, 1e-10), 1e-10
    for _ in range(steps):
        score = b + np.bincount(rows.row, w[rows.column] * rows.value, minlength=rows.n)
        error = (sigmoid(score) - target) * weight / total
        g = np.bincount(rows.column, error[rows.row] * rows.value, minlength=columns) + l2 * w
        if pairs is not None and pairs.n:
            change = np.bincount(pairs.row, w[pairs.column] * pairs.value, minlength=pairs.n)
            g += np.bincount(pairs.column, (2 * pair_weight * change)[pairs.row] * pairs.value, minlength=columns)
        gb = error.sum()
        g2 += g * g
        gb2 += gb * gb
        w -= rate * g / np.sqrt(g2)
        b -= rate * gb / np.sqrt(gb2)
    return w, b
