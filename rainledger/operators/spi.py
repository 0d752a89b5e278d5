"""Standardised precipitation index: a zero-inflated gamma distribution on grouped statistics."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.functions.columns import finite


def base_stats(base: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, zero_share, mean, mean_log) of the base years: all the fit needs, as plain aggregates."""
    v = F.col(value)
    wet = F.when(v > 0, v)
    return base.where(v.isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.avg((v <= 0).cast("double")).alias("zero_share"), F.avg(wet).alias("mean"), F.avg(F.ln(wet)).alias("mean_log"), F.count(wet).alias("n_wet"))


def _digamma(x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for _ in range(8):  # shift up to where the asymptotic series is exact enough
        out, x = out - np.where(x < 8, 1 / x, 0), np.where(x < 8, x + 1, x)
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


def gamma_shape(s: np.ndarray) -> np.ndarray:
    """Shape a of the most likely gamma distribution: ln a - digamma(a) = s = ln mean - mean ln, by Newton's method."""
    a = (3 - s + np.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(30):
        slope = (_digamma(a * (1 + 1e-5)) - _digamma(a * (1 - 1e-5))) / (2e-5 * a)
        a = np.maximum(a - (np.log(a) - _digamma(a) - s) / (1 / a - slope), 1e-9)
    return a


#: Fixed value: shapes above it take the uniform expansion, whose error is below 1e-10 there.
LARGE_SHAPE = 1e5


def gamma_share(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma function by its series, below a + 1, and its continued fraction, above, each until it stands still; about as many terms as ten roots of a are needed. Very large shapes take Temme's expansion."""
    out, large = np.zeros(len(x)), a > LARGE_SHAPE
    for f, own in ((_large_share, large & (x > 0)), (_share_by_terms, ~large & (x > 0))):
        if own.any():
            out[own] = f(a[own], x[own])
    return out


def _share_by_terms(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    scale = np.exp(a * np.log(x) - x - np.array([math.lgamma(v) for v in a]))
    most = 400 + int(40 * math.sqrt(a.max()))
    low, high = np.minimum(x, a + 1), np.maximum(x, a + 1)
    term = total = 1 / a
    for k in range(1, most):
        term = term * low / (a + k)
        total = total + term
        if (term < 1e-17 * total).all():
            break
    b = high + 1 - a
    d = 1 / b
    c, h = np.full_like(x, 1e300), d
    for k in range(1, most):
        b, n = b + 2, -k * (k - a)
        d = n * d + b
        d = 1 / np.where(d == 0, 1e-300, d)
        c = b + n / c
        c = np.where(c == 0, 1e-300, c)
        h = h * d * c
        if (np.abs(d * c - 1) < 1e-16).all():
            break
    return np.where(x < a + 1, np.minimum(scale * total, 1), 1 - scale * h)


def _large_share(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    m = (x - a) / a
    eta = np.sign(m) * np.sqrt(2 * np.maximum(m - np.log1p(m), 0))
    half = np.array([math.erfc(-v) / 2 for v in eta * np.sqrt(a / 2)])
    rest = np.exp(-a * eta * eta / 2) / np.sqrt(2 * math.pi * a) * (-1 / 3 + eta * (1 / 12 - eta * (2 / 135 - eta / 864)))
    return half - rest


def spi(values: DataFrame, base: DataFrame, keys: list[str], value: str, least_years: int = 30, least_wet: int = 15, clip_p: float = 1e-6, clip_z: float = 3.5) -> DataFrame:
    """values with a column spi; null without a value, enough base years or wet ones. The grouped statistics join the values once; only the special functions run in a pandas function."""

    @F.pandas_udf("double")
    def z(v: pd.Series, q: pd.Series, mean: pd.Series, mean_log: pd.Series) -> pd.Series:
        out = np.full(len(v), np.nan)
        known = (v.notna() & mean.notna()).to_numpy()
        x, share, mu, log = (s.to_numpy(dtype=float)[known] for s in (v, q, mean, mean_log))
        a = gamma_shape(np.maximum(np.log(mu) - log, 1e-12))
        p = share + (1 - share) * gamma_share(a, x * a / mu)
        p = np.clip(np.where(x <= 0, share, p), clip_p, 1 - clip_p)
        out[known] = [min(max(NormalDist().inv_cdf(y), -clip_z), clip_z) for y in p]
        return pd.Series(out)

    stats = base_stats(base, keys, value).where((F.col("n") >= least_years) & (F.col("n_wet") >= least_wet))
    scored = values.join(stats, keys, "left").select(*values.columns, z(value, "zero_share", "mean", "mean_log").alias("spi"))
    return scored.withColumn("spi", finite(F.col("spi")))
