"""Upper tail of the F distribution as an Arrow-batched column function.

Spark has no incomplete-beta function. The tail is evaluated directly (not as
1 - cdf), so very small probabilities keep their relative accuracy.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_FLOOR = 1e-300
_EPS = 1e-15


def _lgamma(values: np.ndarray) -> np.ndarray:
    """Log-gamma; degrees of freedom repeat a lot, so work on distinct values."""
    distinct, where = np.unique(values, return_inverse=True)
    return np.array([math.lgamma(v) for v in distinct])[where]


def _keep_off_zero(v: np.ndarray) -> np.ndarray:
    return np.where(np.abs(v) < _FLOOR, _FLOOR, v)


def _fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz).

    Rows that have converged leave the working set; the steps grow with the square root
    of the degrees of freedom.
    """
    result = np.empty_like(x)
    idx = np.arange(x.size)
    c = np.ones_like(x)
    d = 1.0 / _keep_off_zero(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    m = 0
    while idx.size:
        m += 1
        am = a + 2 * m
        step = m * (b - m) * x / ((am - 1.0) * am)
        d = 1.0 / _keep_off_zero(1.0 + step * d)
        c = _keep_off_zero(1.0 + step / c)
        h = h * d * c
        step = -(a + m) * (a + b + m) * x / (am * (am + 1.0))
        d = 1.0 / _keep_off_zero(1.0 + step * d)
        c = _keep_off_zero(1.0 + step / c)
        delta = d * c
        h = h * delta
        done = ~(np.abs(delta - 1.0) >= _EPS)  # an undefined row is done, too
        if done.any():
            result[idx[done]] = h[done]
            live = ~done
            idx, a, b, x, c, d, h = (v[live] for v in (idx, a, b, x, c, d, h))
    return result


def f_tail(f: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """P(F > f) for d1 and d2 degrees of freedom; NaN where undefined."""
    f, d1, d2 = (np.asarray(v, dtype="float64") for v in (f, d1, d2))
    out = np.full(f.shape, np.nan)
    ok = (f >= 0) & (d1 > 0) & (d2 > 0)  # NaN compares false
    out[ok & np.isinf(f)] = 0.0
    ok &= np.isfinite(f)
    if not ok.any():
        return out
    f, d1, d2 = f[ok], d1[ok], d2[ok]
    a, b = d2 / 2.0, d1 / 2.0
    x = d2 / (d2 + d1 * f)
    y = d1 * f / (d2 + d1 * f)  # 1 - x without cancellation
    with np.errstate(divide="ignore", under="ignore"):
        log_front = _lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log(y)
        front = np.exp(log_front)
    p = np.empty_like(f)
    flip = x > (a + 1.0) / (a + b + 2.0)
    direct = ~flip
    p[direct] = front[direct] * _fraction(a[direct], b[direct], x[direct]) / a[direct]
    p[flip] = 1.0 - front[flip] * _fraction(b[flip], a[flip], y[flip]) / b[flip]
    out[ok] = np.clip(p, 0.0, 1.0)
    return out


@F.pandas_udf(DoubleType())
def f_sf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Column function: F upper tail, NULL where a statistic or a df is missing."""
    p = f_tail(f.to_numpy(float, na_value=np.nan), d1.to_numpy(float, na_value=np.nan),
               d2.to_numpy(float, na_value=np.nan))
    return pd.Series(p).astype("Float64").mask(np.isnan(p))


# Ship this module's code with the function, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
