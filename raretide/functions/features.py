"""Row-level feature operators and the whole feature step as one projection.

``engineer`` returns a single ``select``: every engineered column is an
expression over the input row, so the step is a narrow map (no shuffle) that
fuses into the scan's codegen stage.  Null rules follow the reference (see
SURVEY section 4.3): flags and counts treat NULL as missing, ratios use
``try_divide`` (a zero divisor gives NULL, which the imputer fills later).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raretide.functions import rowstats as rs
from raretide.spec import FeatureSpec


def _num(c: str) -> str:
    return c.split("_", 1)[1] if c.startswith("feature_") else c


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def missing_flag(c: str) -> Column:
    return F.col(c).isNull().cast("tinyint").alias(f"{c}_miss")


def ratio(a: str, b: str, null_safe: bool = False) -> Column:
    num, den = (_z(a), _z(b)) if null_safe else (F.col(a), F.col(b))
    return F.try_divide(num, den + 1).alias(f"fe_ratio_{_num(a)}_{_num(b)}")


def product(a: str, b: str) -> Column:
    return (F.col(a) * F.col(b)).alias(f"fe_{_num(a)}_x_{_num(b)}")


def square(a: str) -> Column:
    return (F.col(a) * F.col(a)).alias(f"fe_{_num(a)}_sq")


def log_clip(a: str, null_safe: bool = False) -> Column:
    """``log1p(max(x, 0))``; without ``null_safe`` a null stays null."""
    if null_safe:
        return F.log1p(F.greatest(_z(a), F.lit(0.0))).alias(f"fe_{_num(a)}_log")
    return F.when(F.col(a).isNotNull(), F.log1p(F.greatest(F.col(a), F.lit(0.0)))).alias(f"fe_{_num(a)}_log")


def pairwise_and(binary_cols: list[str]) -> list[Column]:
    """First 8 binary columns crossed with the following ones up to the 9th."""
    out = []
    for i, c1 in enumerate(binary_cols[:8]):
        for c2 in binary_cols[i + 1:9]:
            out.append((_z(c1) * _z(c2)).try_cast("tinyint").alias(f"fe_{c1}_{c2}"))
    return out


def dominant_interactions(spec: FeatureSpec) -> list[Column]:
    d = spec.dominant
    if d is None:
        return []
    dz = _z(d)
    out = [(dz * (_z(c) if safe else F.col(c))).alias(f"fe_{_num(d)}_x_{_num(c)}") for c, safe in spec.dominant_with]
    if spec.dominant_div:
        out.append(F.try_divide(dz, _z(spec.dominant_div) + 1).alias(f"fe_{_num(d)}_div_{_num(spec.dominant_div)}"))
    if spec.dominant_square:
        out.append((dz * dz).alias(f"fe_{_num(d)}_sq"))
    return out


_N, _MEAN, _M2, _M3, _M4 = "__fe_n", "__fe_mean", "__fe_m2", "__fe_m3", "__fe_m4"


def row_stat_columns(feat: list[str], spec: FeatureSpec, n: Column | None = None,
                     mean: Column | None = None, m2: Column | None = None, m3: Column | None = None,
                     m4: Column | None = None) -> list[Column]:
    """Row statistics; pass ``n``/``mean`` and the central sums as columns of
    earlier projections, so each is computed once per row."""
    out = [
        rs.nan_count(feat).cast("double").alias("fe_nan_count"),
        rs.zero_count(feat, null_is_zero=spec.version >= 2).cast("double").alias("fe_zero_count"),
        rs.row_sum(feat).alias("fe_row_sum"),
        (rs.row_mean(feat) if mean is None else mean).alias("fe_row_mean"),
        rs.row_std(feat, n, mean, m2).alias("fe_row_std"),
        rs.row_max(feat).alias("fe_row_max"),
        rs.row_min(feat).alias("fe_row_min"),
    ]
    if spec.row_median:
        out.append(rs.row_median(feat).alias("fe_row_median"))
    if spec.row_skew:
        out.append(rs.row_skew(feat, n, mean, m2, m3).alias("fe_row_skew"))
    if spec.row_kurt:
        out.append(rs.row_kurt(feat, n, mean, m2, m4).alias("fe_row_kurt"))
    return out


def binary_columns(binary: list[str], spec: FeatureSpec) -> list[Column]:
    if not binary:
        return []
    total = rs.row_sum(binary)
    out = [total.alias("fe_binary_sum")]
    if spec.binary_mean:
        out.append((total / F.lit(float(len(binary)))).alias("fe_binary_mean"))
    return out


def engineer(df: DataFrame, spec: FeatureSpec, feature_cols: list[str] | None = None,
             detected_binary: list[str] | None = None) -> DataFrame:
    """Add every engineered column of ``spec`` in one projection.

    ``feature_cols`` are the original inputs (row statistics run over these);
    default: all columns except ``id``/``target``.  With ``spec.auto_binary``
    the binary list comes from ``detected_binary`` (fit on train with
    :func:`raretide.operators.profile.detect_binary`, applied to both sides).
    """
    present = set(df.columns)
    feat = feature_cols or [c for c in df.columns if c not in ("id", "target")]
    miss = [c for c in spec.miss_cols if c in present]
    if spec.auto_binary:
        binary = [c for c in (detected_binary or []) if c in present]
    else:
        binary = [c for c in spec.binary_cols if c in present]
    # Projection 1 computes the per-row count and mean once, projection 2 the
    # central sums, projection 3 references them (Catalyst does not re-inline a non-trivial expression
    # that is used many times, so the central sums stay linear in width).
    df = df.select("*", rs.present_count(feat).alias(_N), rs.row_mean(feat).alias(_MEAN))
    df = df.select("*", *[rs.central_sum(feat, F.col(_MEAN), k).alias(m) for k, m in ((2, _M2), (3, _M3), (4, _M4))])
    cols: list[Column] = [F.col(c) for c in df.columns if c not in (_N, _MEAN, _M2, _M3, _M4)]
    cols += [missing_flag(c) for c in miss]
    cols += row_stat_columns(feat, spec, F.col(_N), F.col(_MEAN), F.col(_M2), F.col(_M3), F.col(_M4))
    cols += binary_columns(binary, spec)
    if spec.pairwise:
        cols += pairwise_and(binary)
    cols += [ratio(a, b, s) for a, b, s in spec.ratios if a in present and b in present]
    cols += [product(a, b) for a, b in spec.products if a in present and b in present]
    cols += [square(a) for a in spec.squares if a in present]
    cols += [log_clip(a, s) for a, s in spec.logs if a in present]
    if spec.dominant in present:
        cols += dominant_interactions(spec)
    if spec.miss_pattern_sum and miss:
        cols.append(rs._sum([F.col(c).isNull().cast("int") for c in miss]).cast("double").alias("fe_miss_pattern_sum"))
    return df.select(*cols)
