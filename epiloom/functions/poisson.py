"""Exact Poisson confidence limits for an event count.

The limits of a count k are quantiles of gamma distributions with shapes k and
k + 1 (half of chi-square quantiles with 2k and 2k + 2 degrees of freedom).
They are computed per Arrow batch, on aggregated rows only, by one method for
counts of any size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER = 100_000

# Standard normal quantiles.
_NORMAL = {0.025: -1.959963984540054, 0.975: 1.959963984540054}
_TAIL = 45.0  # what lies further out than exp(-45) of the peak is left out
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(128)
_MOST_STEPS = 60


def _log_peak(shape: np.ndarray) -> np.ndarray:
    """log of shape^shape exp(-shape) / gamma(shape), by Stirling's series from 16 on, which moves smaller shapes up."""
    steps = np.maximum(0, np.ceil(16 - shape)).astype(int)
    big = shape + steps
    series = 1 / (12 * big) - 1 / (360 * big**3) + 1 / (1260 * big**5) - 1 / (1680 * big**7)
    log_gamma = (big - 0.5) * np.log(big) - big + 0.5 * math.log(2 * math.pi) + series
    for i in range(int(steps.max(initial=0))):
        log_gamma = log_gamma - np.where(i < steps, np.log(shape + i), 0.0)
    return np.where(steps > 0, shape * np.log(shape) - shape - log_gamma, 0.5 * np.log(big / (2 * math.pi)) - series)


def _log_density(shape: np.ndarray, v: np.ndarray) -> np.ndarray:
    """log of the gamma density of log(x / shape) at v."""
    return shape * (v - np.expm1(v))


def _gamma_cdf(shape: np.ndarray, v: np.ndarray, peak: np.ndarray) -> np.ndarray:
    """P(X <= shape * exp(v)): the density of log(X / shape), which is smooth for every shape, summed by Gauss and Legendre."""
    c = _TAIL / shape
    low = -(c / 3 + np.sqrt(c * c / 9 + 2 * c)) - c
    low = np.minimum(low, v - 1e-9)
    half = (v - low) / 2
    points = (v + low)[:, None] / 2 + half[:, None] * _NODES
    return half * (np.exp(_log_density(shape[:, None], points) + peak[:, None]) @ _WEIGHTS)


def gamma_quantile(p: float, shape: np.ndarray) -> np.ndarray:
    """x with cdf(x) = p for shapes of 1 and more: Newton steps in log(x), at the same cost for every shape.

    ArithmeticError if the steps do not settle.
    """
    shape = np.asarray(shape, dtype=float)
    peak = _log_peak(shape)
    v = 3 * np.log(np.maximum(1 - 1 / (9 * shape) + _NORMAL[p] / (3 * np.sqrt(shape)), 0.25))
    spread = 1 / np.sqrt(shape)
    for _ in range(_MOST_STEPS):
        step = (_gamma_cdf(shape, v, peak) - p) / np.exp(_log_density(shape, v) + peak)
        step = np.clip(step, -spread, spread)
        v = v - step
        if not np.any(np.abs(step) > 1e-11 * spread):
            return shape * np.exp(v)
    raise ArithmeticError("Poisson limits did not converge")


_LIMITS = T.StructType([T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())])


@F.pandas_udf(_LIMITS)
def _limits(counts: pd.Series) -> pd.DataFrame:
    known = counts.notna() & (counts > 0)
    shapes, back = np.unique(counts[known].to_numpy(dtype=float), return_inverse=True)
    result = pd.DataFrame({"lower": np.nan, "upper": np.nan}, index=counts.index, dtype=object)
    result.loc[known, "lower"] = gamma_quantile(0.025, shapes)[back]
    result.loc[known, "upper"] = gamma_quantile(0.975, shapes + 1)[back]
    return result.where(result.notna(), None).astype(object)


def poisson_limits(count: Column) -> Column:
    """struct(lower, upper) of the 95 % limits of a count; null for 0 or null."""
    return _limits(count)


@F.pandas_udf(_LIMITS)
def _weighted_limits(rates: pd.Series, variances: pd.Series, widest: pd.Series) -> pd.DataFrame:
    known = rates.notna() & (rates > 0)
    r, v, w = (x[known].to_numpy(dtype=float) for x in (rates, variances, widest))
    result = pd.DataFrame({"lower": np.nan, "upper": np.nan}, index=rates.index, dtype=object)
    result.loc[known, "lower"] = v / r * gamma_quantile(0.025, r * r / v)
    r, v = r + w, v + w * w
    result.loc[known, "upper"] = v / r * gamma_quantile(0.975, r * r / v)
    return result.where(result.notna(), None).astype(object)


def weighted_limits(rate: Column, variance: Column, widest: Column) -> Column:
    """struct(lower, upper) of the 95 % limits of a weighted sum of Poisson counts; null for a sum of 0 or null.

    The gamma method (Fay and Feuer, 1997) on the sum, its variance (counts by squared weights) and the largest weight. As counts are whole,
    no shape is below 1; with one weight these are the exact limits of the count.
    """
    return _weighted_limits(rate, variance, widest)


def rate(count: Column, person_days: Column) -> Column:
    """Events per 100 000 person-years; null without person-time."""
    return F.when(person_days > 0, count / (person_days / F.lit(365.25)) * PER)
