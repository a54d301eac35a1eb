"""Row-wise statistics over a list of numeric columns, skipping nulls.

Everything except the median is a plain arithmetic expression over the
columns (no arrays, no lambdas), so it stays inside whole-stage codegen and
Catalyst's common-subexpression elimination shares the repeated terms.
Semantics follow the pandas row reductions the reference uses: sample std,
bias-corrected skew (G1) and excess kurtosis (G2), zero for a zero-variance row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: pandas treats central sums below this magnitude as exact zeros.
FP_ZERO = 1e-14


def _sum(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols) if cols else F.lit(0)


def nan_count(cols: list[str]) -> Column:
    return _sum([F.col(c).isNull().cast("int") for c in cols])


def present_count(cols: list[str]) -> Column:
    return _sum([F.col(c).isNotNull().cast("int") for c in cols])


def zero_count(cols: list[str], null_is_zero: bool = True) -> Column:
    """v2+: ``fillna(0) == 0`` (a null counts); v1: ``== 0`` (a null does not)."""
    if null_is_zero:
        return _sum([(F.coalesce(F.col(c), F.lit(0.0)) == 0).cast("int") for c in cols])
    return _sum([F.coalesce(F.col(c) == 0, F.lit(False)).cast("int") for c in cols])


def row_sum(cols: list[str]) -> Column:
    """Sum skipping nulls; an all-null row sums to 0."""
    return _sum([F.coalesce(F.col(c), F.lit(0.0)) for c in cols]).cast("double")


def row_mean(cols: list[str]) -> Column:
    n = present_count(cols)
    return F.when(n > 0, row_sum(cols) / n)


def _central(cols: list[str], mean: Column, power: int) -> Column:
    terms = []
    for c in cols:
        d = F.col(c) - mean
        t = d * d
        if power == 3:
            t = t * d
        elif power == 4:
            t = t * t
        terms.append(F.coalesce(t, F.lit(0.0)))
    return _sum(terms)


def central_sum(cols: list[str], mean: Column, power: int) -> Column:
    """Sum of the ``power``-th powers of the distances from ``mean``."""
    return _central(cols, mean, power)


def row_std(cols: list[str], n: Column | None = None, mean: Column | None = None, m2: Column | None = None) -> Column:
    """Sample standard deviation (n - 1); fewer than two values -> null."""
    n = present_count(cols) if n is None else n
    m2 = _central(cols, row_mean(cols) if mean is None else mean, 2) if m2 is None else m2
    return F.when(n >= 2, F.sqrt(m2 / (n - 1)))


def row_max(cols: list[str]) -> Column:
    return F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def row_min(cols: list[str]) -> Column:
    return F.least(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def row_median(cols: list[str]) -> Column:
    """Median of the non-null values (mean of the middle two for an even count)."""
    arr = F.array_sort(F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda x: x.isNotNull()))
    n = F.size(arr)
    lo = F.element_at(arr, F.floor((n + 1) / 2).cast("int"))
    hi = F.element_at(arr, F.floor(n / 2).cast("int") + 1)
    return F.when(n > 0, (lo + hi) / 2)


def _fp(c: Column) -> Column:
    return F.when(F.abs(c) < FP_ZERO, F.lit(0.0)).otherwise(c)


def row_skew(cols: list[str], n: Column | None = None, mean: Column | None = None, m2: Column | None = None,
             m3: Column | None = None) -> Column:
    """Adjusted Fisher-Pearson skewness; n < 3 -> null; zero variance -> 0."""
    n = (present_count(cols) if n is None else n).cast("double")
    mean = row_mean(cols) if mean is None else mean
    m2 = _fp(_central(cols, mean, 2) if m2 is None else m2)
    m3 = _fp(_central(cols, mean, 3) if m3 is None else m3)
    g1 = (n * F.sqrt(n - 1) / (n - 2)) * (m3 / F.pow(m2, 1.5))
    return F.when(n < 3, F.lit(None).cast("double")).when(m2 == 0, F.lit(0.0)).otherwise(g1)


def row_kurt(cols: list[str], n: Column | None = None, mean: Column | None = None, m2: Column | None = None,
             m4: Column | None = None) -> Column:
    """Bias-corrected excess kurtosis; n < 4 -> null; zero variance -> 0."""
    n = (present_count(cols) if n is None else n).cast("double")
    mean = row_mean(cols) if mean is None else mean
    m2 = _central(cols, mean, 2) if m2 is None else m2
    m4 = _central(cols, mean, 4) if m4 is None else m4
    num = _fp(n * (n + 1) * (n - 1) * m4)
    den = _fp((n - 2) * (n - 3) * m2 * m2)
    adj = 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3))
    return F.when(n < 4, F.lit(None).cast("double")).when(den == 0, F.lit(0.0)).otherwise(num / den - adj)
