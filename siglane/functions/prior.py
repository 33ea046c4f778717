"""Fitting the two-gamma prior of EBGM to a squashed table of counts."""

from __future__ import annotations

import math

import numpy as np

from siglane.functions.stats import digamma, log_gamma, log_ratio, trigamma

Prior = tuple[float, float, float, float, float]


def log_mass(n: np.ndarray, e: np.ndarray, prior: Prior) -> np.ndarray:
    """log probability of a count under the mixture: each component a negative binomial."""
    a1, b1, _, _, share = prior
    one = log_gamma(n + a1) - log_gamma(np.full_like(n, a1)) - log_gamma(n + 1) + a1 * np.log(b1 / (b1 + e)) + n * np.log(e / (b1 + e))
    return math.log(share) + one + np.logaddexp(0.0, log_ratio(n, e, prior))


def log_likelihood(n: np.ndarray, e: np.ndarray, weight: np.ndarray, prior: Prior, least: int = 0) -> float:
    """Of counts that are seen only from ``least`` on: each by its probability among these."""
    below = np.zeros_like(e)
    for k in range(least):
        below += np.exp(log_mass(np.full_like(e, k), e, prior))
    return float((weight * (log_mass(n, e, prior) - np.log1p(-np.minimum(below, 1 - 1e-15)))).sum())


def _shape(mean: float, log_mean: float) -> float:
    """The gamma shape for which log(shape) - digamma(shape) is log(mean) minus the mean of logs."""
    gap = max(math.log(mean) - log_mean, 1e-12)
    a = (3 - gap + math.sqrt((gap - 3) ** 2 + 24 * gap)) / (12 * gap)
    for _ in range(50):
        x = np.array([a])
        value, slope = math.log(a) - float(digamma(x)[0]) - gap, 1 / a - float(trigamma(x)[0])
        new = a - value / slope
        new = new if new > 0 else a / 2
        if abs(new - a) < 1e-14 * a:
            return new
        a = new
    return a


def _step(n: np.ndarray, e: np.ndarray, weight: np.ndarray, prior: Prior, least: int) -> Prior:
    """One round of expectation and maximisation; the counts below ``least`` that must have been are added in."""
    if least:
        mass = [np.exp(log_mass(np.full_like(e, k), e, prior)) for k in range(least)]
        seen = np.maximum(1 - sum(mass), 1e-15)
        n = np.concatenate([n, *(np.full_like(e, k) for k in range(least))])
        weight = np.concatenate([weight, *(weight * m / seen for m in mass)])
        e = np.tile(e, least + 1)
    a1, b1, a2, b2, _ = prior
    two = 1 / (1 + np.exp(-np.clip(log_ratio(n, e, prior), -700, 700)))
    out = []
    for a, b, q in ((a1, b1, 1 - two), (a2, b2, two)):
        own = weight * q
        whole = max(own.sum(), 1e-300)
        mean = (own * (a + n) / (b + e)).sum() / whole
        logs = (own * (digamma(a + n) - np.log(b + e))).sum() / whole
        shape = _shape(float(mean), float(logs))
        out += [shape, shape / float(mean)]
    return (*out, float(np.clip((weight * (1 - two)).sum() / weight.sum(), 1e-9, 1 - 1e-9)))


def _free(prior: Prior) -> np.ndarray:
    return np.array([*(math.log(x) for x in prior[:4]), math.log(prior[4] / (1 - prior[4]))])


def _bound(x: np.ndarray) -> Prior:
    x = np.clip(x, -30, 30)
    return (*(float(math.exp(v)) for v in x[:4]), 1 / (1 + math.exp(-x[4])))


def fit(n: np.ndarray, e: np.ndarray, weight: np.ndarray, start: Prior, least: int = 0, rounds: int = 5000, near: float = 1e-13) -> Prior:
    """The prior of the largest likelihood that expectation and maximisation reach from ``start``.

    Two rounds show where they lead; a longer step that way is taken where it gains more than they do (squared
    extrapolation). It ends when a step gains less than ``near`` of the likelihood, or after ``rounds`` steps.
    """
    if not len(n) or not weight.sum() > 0:
        return start
    now, value = start, log_likelihood(n, e, weight, start, least)
    for _ in range(rounds):
        one = _step(n, e, weight, now, least)
        two = _step(n, e, weight, one, least)
        r, v = _free(one) - _free(now), _free(two) - 2 * _free(one) + _free(now)
        best, top = two, log_likelihood(n, e, weight, two, least)
        if (v != 0).any():
            far = -max(1.0, float(np.linalg.norm(r) / np.linalg.norm(v)))
            while far < -1.01:
                tried = _step(n, e, weight, _bound(_free(now) - 2 * far * r + far * far * v), least)
                gain = log_likelihood(n, e, weight, tried, least)
                if gain > top:
                    best, top = tried, gain
                    break
                far = (far - 1) / 2
        done = top - value <= near * max(1.0, abs(top))
        now, value = best, max(value, top)
        if done:
            break
    return now
