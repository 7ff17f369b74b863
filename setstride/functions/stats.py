"""Student-t tail probability for the few rows of a finished aggregate."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz evaluation)."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    h = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * h / a


def student_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p value of a t statistic; null where t is null."""

    @F.pandas_udf("double")
    def tail(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(
            [None if pd.isna(a) or pd.isna(b) else student_two_sided(a, b) for a, b in zip(t, df)], dtype="float64"
        )

    return tail(t, df)
