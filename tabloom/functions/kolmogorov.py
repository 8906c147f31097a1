"""Distributions of Kolmogorov-Smirnov distances: exact for small samples, the limit for large ones.

A table of distances has one row per column and class, so the exact values, which are computed by row
in plain numbers, cost nothing beside the scans that found the distances.
"""

from __future__ import annotations

import sys
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Workers may not have this package: what runs there is sent along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sample sizes below which a one-sample distribution is taken exactly.
EXACT_ROWS = 100
#: Product of two sample sizes below which a two-sample distribution is taken exactly.
EXACT_PAIRS = 10_000
#: Terms of the alternating series for the limiting distribution; the next one is below 1e-30
#: wherever the series is used.
SERIES_TERMS = 12


def one_sample_p_value(statistic: float, n: int) -> float:
    """Probability of a distance of at least ``statistic`` between n draws and their own continuous distribution.

    The chance of staying below is n! / n^n times an entry of the n-th power of a band matrix that
    counts how the draws can fall into cells of width 1/n (Durbin's form, in the layout of Marsaglia,
    Tsang and Wang)."""
    if statistic <= 0.5 / n:
        return 1.0
    if statistic >= 1:
        return 0.0
    cells = int(n * statistic) + 1
    rest = cells - n * statistic
    size = 2 * cells - 1
    steps = np.subtract.outer(np.arange(size), np.arange(size)) + 1
    counts = (steps >= 0).astype(float)
    for i in range(size):
        counts[i, 0] -= rest ** (i + 1)
        counts[-1, i] -= rest ** (size - i)
    counts[-1, 0] += max(0.0, 2 * rest - 1) ** size
    counts /= np.vectorize(lambda k: float(factorial(max(k, 0))))(steps)
    ways = np.linalg.matrix_power(counts, n)[cells - 1, cells - 1]
    for k in range(1, n + 1):
        ways *= k / n
    return float(min(1.0, max(0.0, 1.0 - ways)))


def two_sample_p_value(statistic: float, n: int, m: int) -> float:
    """Probability of a distance of at least ``statistic`` between samples of n and m draws from one continuous distribution.

    Orders of the pooled draws are paths through an n by m grid, all equally likely; those that never
    reach the distance are summed up step by step, as probabilities."""
    reached = statistic - 1e-9 / (n * m)
    share = np.arange(m + 1) / m
    inside = share < reached
    chance = np.cumprod(inside).astype(float)  # the one path along the edge
    for i in range(1, n + 1):
        inside = np.abs(i / n - share) < reached
        row = np.zeros(m + 1)
        for j in range(m + 1):
            if inside[j]:
                # Of the first i + j draws, the last is one of the first sample's with a chance of i / (i + j).
                row[j] = chance[j] * i / (i + j) + (row[j - 1] * j / (i + j) if j else 0.0)
        chance = row
    return float(min(1.0, max(0.0, 1.0 - chance[m])))


def limiting_p_value(argument: Column) -> Column:
    """The limit for large samples, of the distance times the root of the effective sample size. The
    series needs a large argument; below 0.2 the p-value is 1 to more than ten places."""
    x = F.greatest(argument, F.lit(0.2))
    total = F.lit(0.0)
    for k in range(1, SERIES_TERMS + 1):
        total = total + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * x * x)
    return F.when(argument <= 0.2, F.lit(1.0)).when(argument > 0.2, F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


@F.pandas_udf(T.DoubleType())
def _one_sample(statistic: pd.Series, n: pd.Series) -> pd.Series:
    known = statistic.notna() & n.notna() & (n > 0) & (n < EXACT_ROWS)
    return pd.Series([one_sample_p_value(s, int(k)) if ok else None for s, k, ok in zip(statistic, n, known, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _two_sample(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    known = statistic.notna() & (n > 0) & (m > 0) & (n * m < EXACT_PAIRS)
    return pd.Series([two_sample_p_value(s, int(a), int(b)) if ok else None for s, a, b, ok in zip(statistic, n, m, known, strict=True)], dtype="float64")


def one_sample(statistic: Column, n: Column) -> Column:
    """p-value of a one-sample distance from n values, exact below ``EXACT_ROWS`` values."""
    return F.when(n < EXACT_ROWS, _one_sample(statistic, n)).otherwise(limiting_p_value(F.sqrt(n.cast("double")) * statistic))


def two_sample(statistic: Column, n: Column, m: Column) -> Column:
    """p-value of a two-sample distance, exact where the product of the sizes is below ``EXACT_PAIRS``."""
    effective = n.cast("double") * m.cast("double") / (n + m).cast("double")
    return F.when(n * m < EXACT_PAIRS, _two_sample(statistic, n, m)).otherwise(limiting_p_value(F.sqrt(effective) * statistic))
