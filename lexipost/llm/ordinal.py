"""A cumulative-link model for ordered grades over sparse binary features.

P(grade <= k) = sigmoid(threshold_k - w.x). One weight vector is shared by all grades and
only the ascending thresholds tell them apart. The fit is by full gradients with Adam
steps, and an L1 penalty, applied as a shrinking step, leaves few weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) per score (row) and threshold k (column)."""
        return sigmoid(np.asarray(scores, float)[:, None] - self.thresholds)

    def expected(self, scores: np.ndarray) -> np.ndarray:
        """The expected grade: the sum of P(grade > k) over the thresholds."""
        return self.above(scores).sum(axis=1)


def _thresholds(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))


def fit_ordinal(
    features: np.ndarray,
    lengths: np.ndarray,
    grades: np.ndarray,
    n_features: int,
    n_grades: int,
    steps: int = 150,
    rate: float = 0.1,
    l1: float = 2e-4,
) -> OrdinalModel:
    """Fit on documents whose feature numbers stand one after the other in ``features``.

    ``lengths`` says how many each document has (0 is allowed) and ``grades`` are whole
    numbers from 0. Grades that no document has get thresholds that follow the others.
    Without documents all weights are 0 and the lowest grade is certain but for a
    half percent.
    """
    shares = np.bincount(grades, minlength=n_grades) + 0.5
    shares /= shares.sum()
    least = np.cumsum(shares)[:-1]
    start = np.log(least / (1 - least))
    if not len(grades):
        return OrdinalModel(np.zeros(n_features), np.linspace(5.3, 6.3, n_grades - 1))
    raw = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 1e-2))))
    weights = np.zeros(n_features)
    owner = np.repeat(np.arange(len(grades)), lengths)
    moments = [np.zeros(n_features), np.zeros(n_features), np.zeros(len(raw)), np.zeros(len(raw))]
    count = len(grades)
    for step in range(1, steps + 1):
        eta = np.bincount(owner, weights[features], minlength=count)
        cuts = np.concatenate(([-np.inf], _thresholds(raw), [np.inf]))
        high = sigmoid(cuts[grades + 1] - eta)
        low = sigmoid(cuts[grades] - eta)
        chance = np.maximum(high - low, 1e-9)
        slope_high, slope_low = high * (1 - high) / chance, low * (1 - low) / chance
        by_eta = (slope_high - slope_low) / count
        by_weight = np.bincount(features, by_eta[owner], minlength=n_features)
        by_cut = np.bincount(grades, -slope_high, minlength=n_grades)[: n_grades - 1]
        by_cut = (by_cut + np.bincount(grades, slope_low, minlength=n_grades)[1:]) / count
        by_raw = np.append(by_cut.sum(), [by_cut[k:].sum() for k in range(1, len(raw))])
        by_raw[1:] *= np.exp(raw[1:])
        for at, (value, slope) in enumerate(((weights, by_weight), (raw, by_raw))):
            mean, square = moments[2 * at], moments[2 * at + 1]
            mean *= 0.9
            mean += 0.1 * slope
            square *= 0.999
            square += 0.001 * slope * slope
            scale = np.sqrt(square / (1 - 0.999**step)) + 1e-8
            value -= rate * (mean / (1 - 0.9**step)) / scale
            if at == 0:
                shrink = rate * l1 / scale
                np.copyto(value, np.sign(value) * np.maximum(np.abs(value) - shrink, 0))
    return OrdinalModel(weights, _thresholds(raw))
