"""Tail probabilities over Arrow batches, for statistics that Spark computes natively.

Only the last step of a test, from a statistic to a p-value, runs here; each
function maps columns to a column and keeps null where an argument is null or NaN.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lanczos coefficients (g = 7) of the gamma function: fixed values.
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)
_TINY = 1e-300


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of gamma for positive numbers."""
    x = np.asarray(x, float) - 1
    total = np.full(x.shape, _LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], 1):
        total = total + c / (x + i)
    t = x + 7.5
    return 0.5 * np.log(2 * np.pi) + (x + 0.5) * np.log(t) - t + np.log(total)


def beta_inc(a: np.ndarray, b: np.ndarray, x: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.clip(np.where(swap, 1 - x, x), 0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
    keep = lambda v: np.where(np.abs(v) < _TINY, _TINY, v)
    c, d = np.ones(z.shape), 1 / keep(1 - (p + q) * z / (p + 1))
    h = d.copy()
    for m in range(1, rounds):
        for top in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 / keep(1 + top * d)
            c = keep(1 + top / c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1) < 1e-15):
            break
    value = np.where(z == 0, 0.0, front * h)
    return np.clip(np.where(swap, 1 - value, value), 0, 1)


def gamma_upper(a: np.ndarray, x: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Regularised upper incomplete gamma function."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.maximum(np.asarray(x, float), 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.where(x > 0, np.exp(a * np.log(x) - x - log_gamma(a)), 0.0)
    term = total = 1 / a
    for n in range(1, rounds):
        term = term * x / (a + n)
        total = total + term
    b = x + 1 - a
    c, d = np.full(x.shape, 1 / _TINY), 1 / np.where(np.abs(b) < _TINY, _TINY, b)
    h = d.copy()
    for i in range(1, rounds):
        an, b = -i * (i - a), b + 2
        d = an * d + b
        d = 1 / np.where(np.abs(d) < _TINY, _TINY, d)
        c = b + an / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        h = h * d * c
    return np.clip(np.where(x < a + 1, 1 - front * total, front * h), 0, 1)


def student_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def hypergeometric_upper(hits: np.ndarray, marked: np.ndarray, drawn: np.ndarray, total: np.ndarray) -> np.ndarray:
    """P(at least ``hits`` marked ones among ``drawn`` of ``total``, of which ``marked`` are marked)."""
    out = np.ones(len(hits))
    choose = lambda n, k: log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
    for i, (h, m, d, n) in enumerate(zip(hits, marked, drawn, total, strict=True)):
        low, high = int(max(h, 0, d + m - n)), int(min(m, d))
        if h > max(0, d + m - n):
            k = np.arange(low, high + 1, dtype=float)
            out[i] = min(1.0, float(np.exp(choose(m, k) + choose(n - m, d - k) - choose(n, d)).sum())) if len(k) else 0.0
    return out


def _column(function, *arguments: Column) -> Column:  # noqa: ANN001
    """Apply a numpy function to the rows whose arguments are all numbers."""

    @F.pandas_udf("double")
    def run(table: pd.DataFrame) -> pd.Series:
        x = table.to_numpy(float)
        out = np.full(len(x), np.nan)
        ok = ~np.isnan(x).any(axis=1)
        if ok.any():
            out[ok] = function(*x[ok].T)
        return pd.Series(out).astype("Float64").mask(np.isnan(out))

    return run(F.struct(*[a.cast("double").alias(f"a{i}") for i, a in enumerate(arguments)]))


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of a t statistic."""
    return _column(student_two_sided, t, df)


def f_p(f: Column, df1: Column, df2: Column) -> Column:
    """Upper tail of an F statistic."""
    return _column(lambda x, a, b: beta_inc(b / 2, a / 2, b / (b + a * np.maximum(x, 0))), f, df1, df2)


def chi_square_p(x: Column, df: Column) -> Column:
    """Upper tail of a chi-square statistic."""
    return _column(lambda v, k: gamma_upper(k / 2, v / 2), x, df)


def normal_p(z: Column) -> Column:
    """Two-sided p-value of a normal statistic."""
    return _column(lambda v: gamma_upper(np.full(len(v), 0.5), v * v / 2), z)


def hypergeometric_p(hits: Column, marked: Column, drawn: Column, total: Column) -> Column:
    """Upper tail of the hypergeometric distribution, which is also Fisher's one-sided exact test."""
    return _column(hypergeometric_upper, hits, marked, drawn, total)
