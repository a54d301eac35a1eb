"""Median imputation (fit on train, apply anywhere) and z-score standardisation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raretide.operators.quantiles import column_quantiles


@dataclass
class MedianImputerModel:
    medians: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        """A projection: ``coalesce(c, median)`` per fitted column."""
        return df.select(*[
            F.coalesce(F.col(c), F.lit(float(self.medians[c]))).alias(c) if c in self.medians else F.col(c)
            for c in df.columns])


def columns_with_nulls(sides: list[DataFrame], cols: list[str]) -> list[str]:
    """The columns of ``cols`` that a side holds a NULL in: only these need a median."""
    counts = [s.agg(F.count(F.lit(1)), *[F.count(F.col(c)) for c in cols]).first() for s in sides]  # columns x sides numbers
    return [c for i, c in enumerate(cols, 1) if any(row[i] < row[0] for row in counts)]


class MedianImputer:
    """Exact medians (mean of the middle two) of all columns in one distributed pass.

    ``exact=False`` uses ``percentile_approx`` instead (one pass, bounded
    memory, rank error ~1/accuracy).  A column with no value at all gets 0.0
    (the reference's imputer drops such a column instead).
    """

    def __init__(self, cols: list[str], exact: bool = True):
        self.cols, self.exact = list(cols), exact

    def fit(self, train: DataFrame) -> MedianImputerModel:
        rows = column_quantiles(train, self.cols, [0.5], exact=self.exact).collect()  # one row per column
        med = {r["col"]: r["quantile"] for r in rows}
        return MedianImputerModel({c: (med.get(c) if med.get(c) is not None else 0.0) for c in self.cols})

    def medians_frame(self, train: DataFrame) -> DataFrame:
        return column_quantiles(train, self.cols, [0.5], exact=self.exact).select(
            F.col("col").alias("column"), F.col("quantile").alias("median"))


@dataclass
class StandardiserModel:
    stats: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = []
        for c in df.columns:
            if c in self.stats:
                mu, sd = self.stats[c]
                out.append(((F.col(c) - mu) / (sd if sd else 1.0)).alias(c + suffix))
                if suffix:
                    out.append(F.col(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


def fit_standardiser(df: DataFrame, cols: list[str]) -> StandardiserModel:
    """Mean and population std (like a NumPy/scikit scaler; Spark ML's uses n - 1)."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return StandardiserModel({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols})
