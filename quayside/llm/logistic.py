"""Logistic regression on a bounded sample, applied as a column expression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Logistic:
    weights: np.ndarray
    bias: float

    def column(self, inputs: list[Column]) -> Column:
        total = F.lit(float(self.bias))
        for weight, value in zip(self.weights, inputs, strict=True):
            total = total + F.lit(float(weight)) * value
        return 1 / (1 + F.exp(-total))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -500, 500)))


def fit(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, penalty: float = 1.0, steps: int = 50) -> Logistic:
    """Newton's method with a quadratic penalty on the standardised inputs; with one class only, a constant."""
    width = rows.shape[1]
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Logistic(np.zeros(width), 50.0 if share else -50.0)
    weights = np.ones(len(rows)) if weights is None else weights
    mean, spread = rows.mean(0), rows.std(0)
    spread[spread < 1e-12] = 1.0
    inputs = np.hstack([(rows - mean) / spread, np.ones((len(rows), 1))])
    ridge = np.diag([penalty] * width + [1e-9])
    w = np.zeros(width + 1)

    def loss(w: np.ndarray) -> float:
        z = inputs @ w
        return float((weights * (np.logaddexp(0, z) - labels * z)).sum() + w @ ridge @ w / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(inputs @ w, -500, 500)))
        slope = inputs.T @ (weights * (p - labels)) + ridge @ w
        step = np.linalg.solve((inputs * (weights * p * (1 - p) + 1e-9)[:, None]).T @ inputs + ridge, slope)
        scale, now = 1.0, loss(w)
        while scale > 1e-6 and loss(w - scale * step) > now:
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-8:
            break
    own = w[:-1] / spread
    return Logistic(own, float(w[-1] - own @ mean))
