"""Two-sided p-value of a Pearson correlation.

Spark has no t-distribution.  Its tail is a regularized incomplete beta
function, evaluated here for a whole Arrow batch at once; the inputs are
result rows (one per analysed key), not readings.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300

    def floor_tiny(v):
        return np.where(np.abs(v) < tiny, tiny, v)

    c = np.ones_like(x)
    d = 1.0 / floor_tiny(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    for m in range(1, 400):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / floor_tiny(1.0 + even * d)
        c = floor_tiny(1.0 + even / c)
        h = h * d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / floor_tiny(1.0 + odd * d)
        c = floor_tiny(1.0 + odd / c)
        h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    log_front = (
        _lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log1p(-x)
    )
    return np.exp(log_front) * _beta_fraction(a, b, x) / a


def pearson_p(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    r, n = np.asarray(r, dtype=float), np.asarray(n, dtype=float)
    out = np.full(r.shape, np.nan)
    exact = (np.abs(r) >= 1.0) & (n > 2)
    out[exact] = 0.0
    todo = np.isfinite(r) & (n > 2) & ~exact
    if todo.any():
        rr, nu = r[todo], n[todo] - 2.0
        # nu / (nu + t^2) with t = r sqrt(nu / (1 - r^2)) is simply 1 - r^2
        x = (1.0 - rr) * (1.0 + rr)
        half = np.full_like(nu, 0.5)
        # the fraction converges fast below the mean of the distribution;
        # beyond it use the mirrored tail
        mirrored = x > (nu / 2 + 1) / (nu / 2 + half + 2)
        p = np.empty_like(x)
        direct = ~mirrored
        if direct.any():
            p[direct] = _incomplete_beta(nu[direct] / 2, half[direct], x[direct])
        if mirrored.any():
            y = rr[mirrored] ** 2
            zero = y == 0.0
            q = np.zeros_like(y)
            if (~zero).any():
                q[~zero] = _incomplete_beta(half[mirrored][~zero], nu[mirrored][~zero] / 2, y[~zero])
            p[mirrored] = 1.0 - q
        out[todo] = p
    return out


@pandas_udf(T.DoubleType())
def pearson_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    values = pearson_p(r.to_numpy(dtype=float, na_value=np.nan), n.to_numpy(dtype=float, na_value=np.nan))
    return pd.Series(values).astype("Float64").mask(np.isnan(values))
