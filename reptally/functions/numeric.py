"""Distribution functions Spark SQL has no expression for."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def digamma(x: float) -> float:
    shift = 0.0
    while x < 10.0:
        shift -= 1.0 / x
        x += 1.0
    r = 1.0 / (x * x)
    tail = r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r * (1 / 132)))))
    return shift + math.log(x) - 0.5 / x - tail


def trigamma(x: float) -> float:
    shift = 0.0
    while x < 10.0:
        shift += 1.0 / (x * x)
        x += 1.0
    r = 1.0 / (x * x)
    tail = r * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * (5 / 66)))))
    return shift + 1.0 / x + 0.5 * r + tail / x


def gamma_shape(gap: float) -> float:
    """Maximum-likelihood gamma shape from ``gap = log(mean) - mean(log)``.

    Start value and iteration after Minka (2002), "Estimating a Gamma distribution".
    """
    if not gap > 0.0:
        return math.inf
    shape = (3 - gap + math.sqrt((gap - 3) ** 2 + 24 * gap)) / (12 * gap)
    for _ in range(100):
        slope = 1 / shape + (math.log(shape) - digamma(shape) - gap) / (
            shape * shape * (1 / shape - trigamma(shape))
        )
        step = 1 / slope
        if abs(step - shape) <= 1e-14 * shape:
            return step
        shape = step
    return shape


def gamma_cdf(x: np.ndarray, shape: float, scale: float) -> np.ndarray:
    """Lower regularised incomplete gamma function at ``x / scale``."""
    t = np.asarray(x, dtype=float) / scale
    out = np.zeros_like(t)
    out[np.isnan(t)] = np.nan
    low = (t > 0) & (t < shape + 1)
    high = (t >= shape + 1) & np.isfinite(t)
    out[t == np.inf] = 1.0
    out[low] = _series(t[low], shape)
    out[high] = 1.0 - _fraction(t[high], shape)
    return out


def _front(t: np.ndarray, shape: float) -> np.ndarray:
    return np.exp(shape * np.log(t) - t - math.lgamma(shape))


def _series(t: np.ndarray, shape: float) -> np.ndarray:
    term = np.full_like(t, 1.0 / shape)
    total = term.copy()
    n = shape
    while term.size and np.any(term > total * 1e-17):
        n += 1.0
        term = term * t / n
        total += term
    return total * _front(t, shape)


def _fraction(t: np.ndarray, shape: float) -> np.ndarray:
    tiny = 1e-300
    b = t + 1.0 - shape
    c = np.full_like(t, 1.0 / tiny)
    d = 1.0 / b
    h = d.copy()
    for i in range(1, 100_000):
        a = -i * (i - shape)
        b = b + 2.0
        d = a * d + b
        d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
        c = b + a / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        change = d * c
        h = h * change
        if not h.size or np.all(np.abs(change - 1.0) < 1e-16):
            break
    return _front(t, shape) * h


def gamma_quantile(p: float, shape: float, scale: float) -> float:
    """Smallest depth whose probability is not below ``p``, by bisection."""
    if p <= 0:
        return 0.0
    if p >= 1:
        return math.inf

    def at(q: float) -> float:
        return float(gamma_cdf(np.array([q]), shape, scale)[0])

    low, high = 0.0, shape * scale
    while at(high) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if at(mid) < p:
            low = mid
        else:
            high = mid
    return high


def gamma_probability(x: Column, shape: float, scale: float) -> Column:
    """Column form of :func:`gamma_cdf`, in Arrow batches."""

    @F.pandas_udf("double")
    def probability(v: pd.Series) -> pd.Series:
        return pd.Series(gamma_cdf(v.to_numpy(dtype=float), shape, scale))

    return probability(x.cast("double"))


def normal_probability(z: Column) -> Column:
    """Standard normal distribution function, in Arrow batches."""

    @F.pandas_udf("double")
    def probability(v: pd.Series) -> pd.Series:
        flat = v.to_numpy(dtype=float) / -math.sqrt(2.0)
        return pd.Series([0.5 * math.erfc(x) for x in flat], dtype=float)

    return probability(z.cast("double"))


def normal_quantile(p: float) -> float:
    if p >= 1:
        return math.inf
    if p <= 0:
        return -math.inf
    return NormalDist().inv_cdf(p)
