"""Isotonic calibration of scores from bounded, map-side combined bins."""

from __future__ import annotations

import numpy as np

BINS = 1000


def isotonic(values: np.ndarray, targets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted least-squares fit of ``targets`` that never falls along the (sorted) values."""
    level, mass, span = [], [], []
    for t, w in zip(targets, weights, strict=True):
        level.append(float(t))
        mass.append(float(w))
        span.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            total = mass[-2] + mass[-1]
            merged = (level[-2] * mass[-2] + level[-1] * mass[-1]) / total
            level[-2:], mass[-2:], span[-2:] = [merged], [total], [span[-2] + span[-1]]
    return np.repeat(level, span) if level else np.empty(0)


class Calibrator:
    """Maps raw scores in [0, 1] to probabilities, linearly between the fitted points.

    Without any fitted row every score is ``default``.
    """

    def __init__(self, values, targets, weights, default: float = 0.5):
        order = np.argsort(values, kind="stable")
        values, targets, weights = (np.asarray(a, dtype=float)[order] for a in (values, targets, weights))
        self.x, self.default = values, default
        self.y = np.clip(isotonic(values, targets, weights), 0.0, 1.0)

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.x):
            return np.full(len(raw), self.default)
        return np.interp(raw, self.x, self.y)
