"""Logistic regression and Platt calibration on small matrices, on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the bias last, by Newton steps; y may be probabilities."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + penalty * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        size = np.abs(step).max()
        w = w - step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log-odds."""
    return x @ w[:-1] + w[-1]
