"""Tail probabilities that Spark has no built-in for, as vectorised helpers."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, steps + 1):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + top / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-14):
            break
    return h


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p-value of Student's t."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    out = np.ones_like(t)
    ok = np.isfinite(t) & np.isfinite(df) & (df > 0) & (t != 0)
    if not ok.any():
        return out
    a, b = df[ok] / 2.0, np.full(ok.sum(), 0.5)
    x = df[ok] / (df[ok] + t[ok] ** 2)
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    z = np.clip(z, 1e-300, 1.0)
    front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(z) + q * np.log1p(-np.minimum(z, 1 - 1e-16)))
    part = front * _beta_fraction(p, q, z) / p
    out[ok] = np.clip(np.where(swap, 1.0 - part, part), 0.0, 1.0)
    return out


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(t.to_numpy(float), df.to_numpy(float)), index=t.index)


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return pd.Series(_erfc(np.abs(z.to_numpy(float)) / math.sqrt(2.0)), index=z.index)
