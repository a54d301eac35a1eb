"""Profiling aggregations: one pass each, results are small keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raretide.operators.quantiles import exact_quantiles


def target_profile(train: DataFrame, label: str = "target") -> DataFrame:
    """Shape, positive rate, positives/negatives and scale_pos_weight (n_neg / n_pos)."""
    y = F.col(label)
    return train.agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.lit(len(train.columns)).cast("long").alias("n_cols"),
        F.count_if(y == 1).cast("long").alias("n_pos"),
        F.count_if(y == 0).cast("long").alias("n_neg"),
        F.avg(y.cast("double")).alias("pos_rate"),
        F.try_divide(F.count_if(y == 0).cast("double"), F.count_if(y == 1).cast("double")).alias("scale_pos_weight"),
    )


def missing_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: missing count and percent, only columns with at least one null."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__n"], cols, "column", "n_missing")
    return long.filter(F.col("n_missing") > 0).select(
        "column", F.col("n_missing").cast("long").alias("n_missing"),
        (F.col("n_missing") * 100.0 / F.col("__n")).alias("pct_missing"))


def binary_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: whether every non-null value is 0 or 1 (all-null counts as binary)."""
    wide = df.agg(*[F.coalesce(F.bool_and(F.coalesce(F.col(c).isin(0, 1), F.lit(True))), F.lit(True)).alias(c)
                    for c in cols])
    return wide.unpivot([], cols, "column", "is_binary")


def detect_binary(df: DataFrame, cols: list[str]) -> list[str]:
    """Binary column names (a small list brought to the driver to build the projection)."""
    row = binary_profile(df, cols).filter("is_binary").select("column").collect()
    found = {r[0] for r in row}
    return [c for c in cols if c in found]


def smote_preview(train: DataFrame, ratio: float = 0.10, val_share: float = 0.1,
                  label: str = "target") -> DataFrame:
    """Expected synthetic rows per training fold: int(neg' * r / (1 - r)) - pos'."""
    p = target_profile(train, label)
    pos = F.floor(F.col("n_pos") * (1 - val_share)).cast("long")
    neg = F.floor(F.col("n_neg") * (1 - val_share)).cast("long")
    adds = F.floor(neg * ratio / (1 - ratio)).cast("long") - pos
    by_ratio = F.floor(neg * ratio).cast("long") - pos
    return p.select(
        pos.alias("fold_pos"), neg.alias("fold_neg"),
        F.greatest(adds, F.lit(0)).cast("long").alias("synthetic_share"),
        F.greatest(by_ratio, F.lit(0)).cast("long").alias("synthetic_ratio"))


def score_summary(scores: DataFrame, score: str = "score", keys: list[str] | None = None) -> DataFrame:
    """mean, population std, min, max, p99 (linear, exact) and count above 0.5."""
    keys = keys or []
    base = scores.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"),
        F.min(score).alias("min"), F.max(score).alias("max"),
        F.count_if(F.col(score) > 0.5).cast("long").alias("n_over_half"))
    p99 = exact_quantiles(scores, keys, score, [0.99]).select(*keys, F.col("quantile").alias("p99"))
    return base.join(p99, keys) if keys else _one_row_join(base, p99)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    k = "__one"
    return a.withColumn(k, F.lit(1)).join(b.withColumn(k, F.lit(1)), k).drop(k)


def nulls_remaining(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count of NULL cells over ``cols`` (after imputation this must be 0)."""
    total = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in cols])
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.lit(len(cols)).cast("long").alias("n_cols"),
                  F.coalesce(F.sum(total), F.lit(0)).cast("long").alias("n_null"))


def metric_report(metrics: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mean and population std of a per-fold metric."""
    return metrics.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("n_folds"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
