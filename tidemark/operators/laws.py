"""P-values of the Kolmogorov-Smirnov distances: exact for small samples, of the finite-n law for larger ones."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many rows in the larger sample, paths are counted.
EXACT_ROWS = 10_000
# Up to this half width the finite-n law is a power of a matrix, beyond it a series.
MATRIX_HALF = 500


def two_sample(d: float, m: int, n: int) -> float:
    """P(D >= d) of two samples of m and n rows of one continuous law, as statistics libraries choose it."""
    if not m or not n:
        return math.nan
    return exact_two_sample(d, m, n) if max(m, n) <= EXACT_ROWS else one_sample(d, round(m * n / (m + n)))


def exact_two_sample(d: float, m: int, n: int) -> float:
    """The share of orders of the m + n rows whose greatest gap is d or more.

    An order is a path through a grid; the share of paths to a cell that never left the band of smaller gaps
    follows from its two neighbours. Cells are taken a diagonal at a time.
    """
    shared = math.gcd(m, n)
    gap = round(d * (m // shared) * n) * shared  # d in units of 1 / (m * n), as a whole number
    if gap <= 0:
        return 1.0
    share = np.zeros(m + 2)  # by rows of the first sample that have come, one place further on
    share[1] = 1.0
    was = (0, 0)
    for s in range(1, m + n + 1):
        low = max(0, s - n, (s * m - gap) // (m + n) + 1)
        high = min(m, s, -((-s * m - gap) // (m + n)) - 1)
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        new = (i * share[low : high + 1] + (s - i) * share[low + 1 : high + 2]) / s
        share[was[0] + 1 : was[1] + 2] = 0.0
        share[low + 1 : high + 2] = new
        was = low, high
    return min(1.0, max(0.0, 1.0 - float(share[m + 1])))


def one_sample(d: float, n: int) -> float:
    """P(D_n >= d) of n rows against their own continuous law."""
    if d <= 0 or n <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    z = n * d * d
    if z > 18:
        return 2.0 * math.exp(-2.0 * z)
    p = matrix_law(d, n) if n * d <= MATRIX_HALF else series_law(d, n)
    return min(1.0, max(0.0, 1.0 - p))


def matrix_law(d: float, n: int) -> float:
    """P(D_n < d): an entry of the n-th power of a matrix with 2 * ceil(n * d) - 1 rows."""
    k = int(n * d) + 1
    size, h = 2 * k - 1, k - n * d
    steps = np.subtract.outer(np.arange(size), np.arange(size)) + 1
    factorial = np.array([math.lgamma(i + 1.0) for i in range(size + 1)])
    matrix = np.where(steps >= 0, 1.0, 0.0)
    powers = h ** np.arange(1, size + 1)
    matrix[:, 0] -= powers
    matrix[-1, :] -= powers[::-1]
    matrix[-1, 0] += max(0.0, 2 * h - 1) ** size
    matrix *= np.where(steps > 0, np.exp(-factorial[np.maximum(steps, 0)]), 1.0)
    # Powers by squaring; scales are kept apart, as entries leave the range of a double.
    result, scale, base, base_scale, left = np.eye(size), 0.0, matrix, 0.0, n
    while left:
        if left & 1:
            result, scale = result @ base, scale + base_scale
            top = np.abs(result).max()
            result, scale = result / top, scale + math.log(top)
        base, base_scale = base @ base, 2 * base_scale
        top = np.abs(base).max()
        base, base_scale = base / top, base_scale + math.log(top)
        left >>= 1
    entry = float(result[k - 1, k - 1])
    return entry * math.exp(scale + math.lgamma(n + 1.0) - n * math.log(n)) if entry > 0 else 0.0


def series_law(d: float, n: int) -> float:
    """P(D_n < d) by the limit law and its first three corrections in powers of 1 / sqrt(n)."""
    z = d * math.sqrt(n)
    pi2 = math.pi**2
    half = np.arange(0, 200) + 0.5
    e = np.exp(-pi2 * half**2 / (2 * z * z))
    whole = np.arange(1, 200)
    w = np.exp(-pi2 * whole**2 / (2 * z * z))
    root = math.sqrt(math.pi / 2)
    both = lambda terms: 2.0 * float(np.sum(terms))  # sums run over negative numbers, too
    a, b = pi2 * half**2, pi2 * whole**2
    k0 = math.sqrt(2 * math.pi) / z * float(np.sum(e))
    k1 = root / (6 * z**4) * both((a - z * z) * e)
    k2 = root / (72 * z**7) * both(((6 * z**6 + 2 * z**4) + a * (2 * z**4 - 5 * z * z) + a**2 * (1 - 2 * z * z)) * e)
    k2 -= root / (36 * z**3) * both(b * w)
    k3 = root / (6480 * z**10) * both(
        (a**3 * (5 - 30 * z * z) + a**2 * (-60 * z * z + 212 * z**4) + a * (135 * z**4 - 96 * z**6) - 30 * z**6 - 90 * z**8) * e
    )
    k3 += root / (108 * z**6) * both((-(b**2) + 3 * b * z * z) * w)
    return k0 + k1 / math.sqrt(n) + k2 / n + k3 / n**1.5


def p_value(d: Column, n_baseline: Column, n_live: Column) -> Column:
    """:func:`two_sample` of a row's distance and sample sizes: a row for each feature, not for each value."""

    @F.pandas_udf("double")
    def law(gaps: pd.Series, first: pd.Series, second: pd.Series) -> pd.Series:
        each = zip(gaps, first, second)
        return pd.Series([None if pd.isna(g) or pd.isna(a) or pd.isna(b) else two_sample(g, int(a), int(b)) for g, a, b in each])

    return law(d, n_baseline, n_live)
