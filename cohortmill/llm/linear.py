"""A small regularised logistic regression over sparse rows, and pooled adjacent violators for calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    bias: float

    def predict(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        return expit(np.bincount(row, value * self.weights[col], n) + self.bias)


def expit(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(row: np.ndarray, col: np.ndarray, value: np.ndarray, target: np.ndarray, width: int, penalty: float = 1.0, rounds: int = 300) -> Linear:
    """Accelerated gradient descent on the penalised likelihood; the bias is free. No rows, or one class only: a constant."""
    n = len(target)
    rate = (target.sum() + 0.5) / (n + 1)
    bias = float(np.log(rate / (1 - rate)))
    if not n or not width or target.min() == target.max():
        return Linear(np.zeros(max(1, width)), bias)
    mass = np.bincount(col, value**2, width)
    step = 1 / (0.25 * np.minimum(mass * max(1.0, np.bincount(row, value != 0, n).max() ** 0.5), 0.25 * n * 40) + penalty)
    w, v, t, bound = np.zeros(width), np.zeros(width), 1.0, bias
    free = bias
    for _ in range(rounds):
        gap = expit(np.bincount(row, value * v[col], n) + free) - target
        new = v - step * (np.bincount(col, value * gap[row], width) + penalty * v)
        moved = free - gap.sum() / (0.25 * n)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if ((v - new) * (new - w)).sum() > 0:  # overshot: start the momentum anew
            t2, v, free = 1.0, new, moved
        else:
            v, free = new + (t - 1) / t2 * (new - w), moved + (t - 1) / t2 * (moved - bound)
        w, bound, t = new, moved, t2
    return Linear(w, float(bound))
