"""Statistics as column expressions; only the empirical-Bayes posterior needs Python."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from siglane.session import prepare

#: Abramowitz and Stegun 7.1.26. Fixed values.
_ERF = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
_ERF_P = 0.3275911


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function, 0 below -8 and 1 above 8."""
    z = F.abs(x) / math.sqrt(2.0)
    t = 1.0 / (1.0 + F.lit(_ERF_P) * z)
    series = F.lit(0.0)
    for a in reversed(_ERF):
        series = (series + F.lit(a)) * t
    erf = F.signum(x) * (1.0 - series * F.exp(-z * z))
    return F.when(x < -8.0, 0.0).when(x > 8.0, 1.0).otherwise(0.5 * (1.0 + erf))


def chi_squared_tail(x: Column, df: Column) -> Column:
    """Upper tail of the chi-squared distribution by Wilson and Hilferty's approximation."""
    v = F.lit(2.0) / (9.0 * df)
    z = (F.pow(x / df, F.lit(1.0 / 3.0)) - (1.0 - v)) / F.sqrt(v)
    return F.when((x <= 0) | (df <= 0), 1.0).otherwise(F.greatest(F.least(1.0 - normal_cdf(z), F.lit(1.0)), F.lit(0.0)))


def ratio(a: Column, b: Column) -> Column:
    """a / b, infinite where only b is 0, null where both are."""
    return F.when((b == 0) & (a > 0), F.lit(float("inf"))).otherwise(F.try_divide(a, b))


#: Bernoulli numbers B2 to B14 of Stirling's series. Fixed values.
_BERNOULLI = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730, 7 / 6)
#: Shapes from which the incomplete gamma is taken by its uniform expansion, and the terms of that in eta and 1 / shape.
_LARGE, _IN_ETA, _IN_SHAPE = 150.0, 40, 5


def _stirling(x: np.ndarray) -> np.ndarray:
    """log Gamma(x) - (x - 1/2) log x + x - log(2 pi) / 2, for x from 10."""
    y = 1 / (x * x)
    out = np.zeros_like(x)
    for k in range(len(_BERNOULLI), 0, -1):
        out = out * y + _BERNOULLI[k - 1] / (2 * k * (2 * k - 1))
    return out / x


def log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    shift, low = np.zeros_like(x), x < 10
    while low.any():
        shift[low] += np.log(x[low])
        x[low] += 1
        low = x < 10
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + _stirling(x) - shift


def _log_gamma_step(x: np.ndarray, d: float) -> np.ndarray:
    """log Gamma(x + d) - log Gamma(x), for large x without the loss of a difference of large numbers."""
    far = np.maximum(x, 10.0)
    large = d * np.log(far) + (far + d - 0.5) * np.log1p(d / far) - d + _stirling(far + d) - _stirling(far)
    return np.where(x >= 10, large, log_gamma(np.minimum(x, 10.0) + d) - log_gamma(np.minimum(x, 10.0)))


def digamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, dtype=float), np.zeros_like(np.asarray(x, dtype=float))
    while (small := x < 10).any():
        out[small] -= 1 / x[small]
        x[small] += 1
    y = 1 / (x * x)
    series = np.zeros_like(x)
    for k in range(len(_BERNOULLI), 0, -1):
        series = (series + _BERNOULLI[k - 1] / (2 * k)) * y
    return out + np.log(x) - 0.5 / x - series


def trigamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, dtype=float), np.zeros_like(np.asarray(x, dtype=float))
    while (small := x < 10).any():
        out[small] += 1 / (x[small] * x[small])
        x[small] += 1
    y = 1 / (x * x)
    series = np.zeros_like(x)
    for k in range(len(_BERNOULLI), 0, -1):
        series = (series + _BERNOULLI[k - 1]) * y
    return out + 1 / x + y / 2 + series / x


def _uniform_coefficients() -> np.ndarray:
    """Row k: the Taylor coefficients in eta of the k-th function of the expansion in 1 / shape (DLMF 8.12).

    eta^2 / 2 = mu - log(1 + mu) is inverted to a series of mu in eta; the first function is 1 / mu - 1 / eta, and each
    next one the derivative of the one before, over eta, and a share of 1 / mu in which the poles cancel.
    """
    n = _IN_ETA + 2 * _IN_SHAPE + 4
    mu = [0.0, 1.0]
    for k in range(2, n + 2):
        mu.append((mu[k - 1] - sum(j * mu[j] * mu[k + 1 - j] for j in range(2, k))) / (k + 1))
    over = [1.0]  # of eta / mu
    for k in range(1, n + 1):
        over.append(-sum(mu[j + 1] * over[k - j] for j in range(1, k + 1)))
    first = np.array(over[1:])
    # Stirling's coefficients, from the exponential of his series.
    logs = np.zeros(_IN_SHAPE + 1)
    for k in range(1, len(_BERNOULLI) + 1):
        if 2 * k - 1 <= _IN_SHAPE:
            logs[2 * k - 1] = _BERNOULLI[k - 1] / (2 * k * (2 * k - 1))
    gammas = np.zeros(_IN_SHAPE + 1)
    gammas[0] = 1.0
    for k in range(1, _IN_SHAPE + 1):
        gammas[k] = sum(j * logs[j] * gammas[k - j] for j in range(1, k + 1)) / k
    rows, now = [first], first
    for k in range(1, _IN_SHAPE + 1):
        m = np.arange(len(now) - 2)
        now = (m + 2) * now[2:] + (-1) ** k * gammas[k] * first[: len(m)]
        rows.append(now)
    return np.array([r[:_IN_ETA] for r in rows])


_UNIFORM = _uniform_coefficients()
_erfc = np.vectorize(math.erfc, otypes=[float])


def _eta(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    mu = x / a - 1
    near = np.abs(mu) < 1e-2
    small = np.where(near, mu, 0.0)
    # mu - log(1 + mu) near 0 by its series.
    series = np.zeros_like(small)
    for k in range(14, 1, -1):
        series = series * -small + 1 / k
    half = np.where(near, series * small * small, mu - np.log1p(np.maximum(mu, -1 + 1e-300)))
    return np.sign(mu) * np.sqrt(2 * np.maximum(half, 0.0))


def _gamma_large(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(a, x), its density in x) for large a, uniformly in x: the normal distribution of eta, and its correction."""
    eta = _eta(a, x)
    inner = np.clip(eta, -1.0, 1.0)  # beyond, the correction is nothing at these shapes
    total = np.zeros_like(a)
    for row in _UNIFORM[::-1]:
        value = np.zeros_like(inner)
        for c in row[::-1]:
            value = value * inner + c
        total = total / a + value
    bell = np.exp(-np.minimum(0.5 * a * eta * eta, 745.0)) / np.sqrt(2 * math.pi * a)
    p = 0.5 * _erfc(-eta * np.sqrt(a / 2)) - bell * total
    return np.clip(p, 0, 1), bell * a / np.maximum(x, 1e-300) / np.exp(_stirling(a))


def _gamma_small(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(a, x), its density in x): a series below a + 1, a continued fraction above."""
    p, scale = np.zeros_like(x), np.exp(np.where(x > 0, -x + a * np.log(np.maximum(x, 1e-300)) - log_gamma(a), -np.inf))
    low = x < a + 1
    if low.any():
        al, xl = a[low], x[low]
        term = total = 1 / al
        k = 0
        while not (term < total * 1e-16).all():
            k += 1
            term = term * xl / (al + k)
            total = total + term
        p[low] = total * scale[low]
    if (~low).any():
        ah, xh = a[~low], x[~low]
        b = xh + 1 - ah
        c, d = np.full_like(b, 1e300), 1 / b
        h, step, k = d, np.zeros_like(b), 0
        while not (np.abs(step - 1) < 1e-15).all():
            k += 1
            an = -k * (k - ah)
            b = b + 2
            d = 1 / np.where(np.abs(an * d + b) < 1e-300, 1e-300, an * d + b)
            c = np.where(np.abs(b + an / c) < 1e-300, 1e-300, b + an / c)
            step = d * c
            h = h * step
            if k > 50 and (np.abs(step - 1) < 4e-15).all():
                break
        p[~low] = 1 - scale[~low] * h
    return np.clip(p, 0, 1), np.where(x > 0, scale / np.maximum(x, 1e-300), 0.0)


def gamma_p(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(regularised lower incomplete gamma function, its density in x), of any shape above 0."""
    p, f, large = np.zeros_like(x), np.zeros_like(x), a >= _LARGE
    for which, work in ((large, _gamma_large), (~large, _gamma_small)):
        if which.any():
            p[which], f[which] = work(a[which], x[which])
    return p, f


def log_ratio(n: np.ndarray, e: np.ndarray, prior: tuple[float, float, float, float, float]) -> np.ndarray:
    """log of the second component's weight for a count over the first's."""
    a1, b1, a2, b2, share = prior
    fixed = math.log((1 - share) / share) - float(log_gamma(np.array([a2]))[0] - log_gamma(np.array([a1]))[0])
    return fixed + _log_gamma_step(n + a1, a2 - a1) + a2 * np.log(b2 / (b2 + e)) - a1 * np.log(b1 / (b1 + e)) + n * np.log1p((b1 - b2) / (b2 + e))


def posterior(n: np.ndarray, expected: np.ndarray, prior: tuple[float, float, float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """(EBGM, EB05) of counts under a mixture of two gammas, at any count.

    EB05 is found by Newton's steps on the posterior's distribution, held within an interval that is halved where a
    step leaves it.
    """
    a1, b1, a2, b2, _ = prior
    n, e = n.astype(float), np.maximum(expected.astype(float), 1e-12)
    q = 1 / (1 + np.exp(np.clip(log_ratio(n, e, prior), -700, 700)))
    mean = q * (digamma(a1 + n) - np.log(b1 + e)) + (1 - q) * (digamma(a2 + n) - np.log(b2 + e))

    def below(x, at):
        p1, f1 = gamma_p(a1 + n[at], x * (b1 + e[at]))
        p2, f2 = gamma_p(a2 + n[at], x * (b2 + e[at]))
        return q[at] * p1 + (1 - q[at]) * p2, q[at] * f1 * (b1 + e[at]) + (1 - q[at]) * f2 * (b2 + e[at])

    low, high = np.zeros_like(n), np.maximum(np.exp(mean) * 4, 1.0)
    left = np.arange(len(n))
    while len(left):
        left = left[below(high[left], left)[0] < 0.05]
        high[left] *= 2
    # A start near the quantile of one gamma: Wilson and Hilferty's.
    shape = np.maximum(n + q * a1 + (1 - q) * a2, 1e-3)
    start = np.exp(mean) * np.maximum(1 - 1 / (9 * shape) - 1.6448536269514722 / (3 * np.sqrt(shape)), 0.02) ** 3
    x = np.clip(start, high * 1e-12, high)
    left, step = np.arange(len(n)), 0
    while len(left) and step < 200:
        p, f = below(x[left], left)
        under = p < 0.05
        low[left], high[left] = np.where(under, x[left], low[left]), np.where(under, high[left], x[left])
        with np.errstate(divide="ignore", invalid="ignore"):
            new = x[left] - (p - 0.05) / f
        inside = (new > low[left]) & (new < high[left])
        new = np.where(inside, new, (low[left] + high[left]) / 2)
        moved = np.abs(new - x[left]) > 1e-14 * new
        x[left] = new
        left, step = left[moved & (high[left] - low[left] > 1e-15 * high[left])], step + 1
    return np.exp(mean), x


def empirical_bayes(n: Column, expected: Column, prior: tuple[float, float, float, float, float]) -> Column:
    """struct<ebgm, eb05>, in Arrow batches over pairs (not over rows of reports)."""
    prepare(SparkSession.active())

    @F.pandas_udf("ebgm double, eb05 double")
    def run(n: pd.Series, e: pd.Series) -> pd.DataFrame:
        ebgm, eb05 = posterior(n.to_numpy(), e.to_numpy(), prior)
        return pd.DataFrame({"ebgm": ebgm, "eb05": eb05})

    return run(n.cast("double"), expected.cast("double"))
