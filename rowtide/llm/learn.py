"""Numpy helpers for the classifiers: sigmoid, Adam, folds, thresholds."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: A score from here on predicts label 1 (fixed value).
CUT = 0.7
CUT_LOGIT = float(np.log(CUT / (1 - CUT)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Steps for a dictionary of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            self.params[k] -= self.rate * m / (np.sqrt(v) + 1e-8)


def out_of_fold(n: int, folds: int, train: Callable, predict: Callable) -> np.ndarray:
    """Logits of every row by a model that has not seen it; rows are dealt by position."""
    logits = np.zeros(n)
    for fold in range(folds):
        held = np.arange(n) % folds == fold
        logits[held] = predict(train(np.flatnonzero(~held)), np.flatnonzero(held))
    return logits


def threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The cut with the best weighted F1; in the middle of its gap."""
    order = np.argsort(-logits, kind="stable")
    x, y, w = logits[order], labels[order], weights[order]
    hit, taken, all_ = np.cumsum(w * y), np.cumsum(w), (w * y).sum()
    f1 = 2 * hit / (taken + all_)
    last = np.append(x[1:] < x[:-1], True)
    f1[~last] = -1
    at = int(np.argmax(f1))
    below = x[at + 1] if at + 1 < len(x) else x[at] - 1.0
    return float((x[at] + below) / 2)


def natural_weights(labels: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Weights that give a sample the class sizes of all labelled rows."""
    share = {v: totals.get(v, 0) / max(1, int((labels == v).sum())) for v in (0, 1)}
    return np.where(labels == 1, share[1], share[0])
