"""Global order without a single task.

Running sums over a sorted column (ranking metrics, ranks, exact quantiles,
balanced folds) and as-of neighbour lookups (piecewise-linear mapping) need an
order across *all* rows of a key.  A window with no ``partitionBy`` - or with
a handful of hot keys - plans an ``Exchange SinglePartition``.  Here every key
is cut into ``n_buckets`` value ranges whose bounds come from a per-key
``percentile_approx`` (a tiny table of ``n_keys x n_buckets`` numbers):

1. rows are tagged with their bucket (a count of bounds below the value),
2. per-(key, bucket) totals form a tiny table; a window over it gives each
   bucket the totals of all lower buckets (its offset),
3. a window partitioned by (key, bucket) adds the in-bucket running sum.

The result equals the single-window answer exactly; only step 3 touches the
data and it runs in ``n_keys x n_buckets`` parallel partitions.  The bucket
count spreads the shuffle width over the keys (:func:`default_buckets`);
callers whose keys are many and large (the exact blend grid) pass a count
derived from a counted input size.  The tiny tables broadcast back: they hold
``n_keys x n_buckets`` rows, and every caller's keys are bounded by
parameters (folds, models, grid points, feature columns), never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_K = "__ord_key"
_B = "__ord_bucket"
_O = "__ord_val"


def default_buckets(spark: SparkSession, n_keys: int | None = None) -> int:
    """Buckets per key: the shuffle width spread over the keys (at least one).

    Many keys (a weight grid) already fill the cluster, so each gets one
    bucket and the plan is a plain window partitioned by the keys; few keys
    (one metric, two classes) are cut into ``spark.sql.shuffle.partitions``
    ranges each.
    """
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    return max(1, width // max(1, n_keys or 1))


def _with_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(_K, F.lit(0)), [_K]


def bucket_bounds(df: DataFrame, keys: list[str], value: str, n_buckets: int,
                  accuracy: int = 10000) -> DataFrame:
    """Per-key ``n_buckets - 1`` approximate quantiles of ``value`` as an array."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    accuracy = min(accuracy, max(100, 20 * n_buckets))  # bounds only need ~1/(20 n) rank accuracy
    return df.groupBy(*keys).agg(
        F.percentile_approx(F.col(value), probs, accuracy).alias("__bounds"))


def bucket_of(value: Column, bounds: Column) -> Column:
    """Number of bounds strictly below ``value``: monotone in ``value``.

    A binary search over the ascending bounds (up to 2**16 of them), so the
    cost per row does not follow the cluster's width.
    """
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(17))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < value, at + step).otherwise(at))


def _assign(df: DataFrame, keys: list[str], value: Column, n_buckets: int) -> DataFrame:
    df = df.withColumn(_O, value)
    if n_buckets <= 1:
        return df.withColumn(_B, F.lit(0))
    # keys x buckets numbers: broadcast, the data side does not move.
    bounds = F.broadcast(bucket_bounds(df, keys, _O, n_buckets))
    return (df.join(bounds, keys, "left")
              .withColumn(_B, bucket_of(F.col(_O), F.col("__bounds")))
              .drop("__bounds"))


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], sums: list[str],
                descending: bool = False, n_buckets: int | None = None,
                prefix: str = "cum_", totals: bool = True, n_keys: int | None = None, tasks: int | None = None) -> DataFrame:
    """Add inclusive running sums ``cum_<s>`` of ``sums`` over ``order`` within ``keys``.

    ``order`` must be unique within a key (aggregate ties first); the first
    ``order`` column decides the bucket, so ties on it never straddle buckets.
    With ``totals`` the per-key grand totals come back as ``tot_<s>``.  ``tasks`` fixes the
    tasks of the ordered pass (AQE joins partitions by their compressed bytes, which
    many small counters hardly fill).
    """
    n_buckets = default_buckets(df.sparkSession, n_keys) if n_buckets is None else n_buckets
    base, kcols = _with_key(df, keys)
    first = F.col(order[0])
    ordval = -first if descending else first
    tagged = _assign(base, kcols, ordval, n_buckets)

    agg = tagged.groupBy(*kcols, _B).agg(*[F.sum(s).alias(f"__b_{s}") for s in sums])
    wb = Window.partitionBy(*kcols).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*kcols)
    offs = agg.select(
        *kcols, _B,
        *[F.coalesce(F.sum(f"__b_{s}").over(wb), F.lit(0)).alias(f"__off_{s}") for s in sums],
        *([F.sum(f"__b_{s}").over(wt).alias(f"tot_{s}") for s in sums] if totals else []),
    )
    ocols = [(F.col(c).desc() if descending else F.col(c).asc()) for c in order]
    w = Window.partitionBy(*kcols, _B).orderBy(*ocols).rowsBetween(Window.unboundedPreceding, 0)
    if n_buckets <= 1:
        w1 = Window.partitionBy(*kcols).orderBy(*ocols)
        return base.select(
            *[F.col(c) for c in df.columns],
            *[F.sum(s).over(w1.rowsBetween(Window.unboundedPreceding, 0)).alias(f"{prefix}{s}") for s in sums],
            *([F.sum(s).over(Window.partitionBy(*kcols)).alias(f"tot_{s}") for s in sums] if totals else []))
    rows = tagged if tasks is None else tagged.repartition(tasks, *kcols, _B)
    out = rows.join(F.broadcast(offs), kcols + [_B], "left").select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"__off_{s}") + F.sum(s).over(w)).alias(f"{prefix}{s}") for s in sums],
        *([F.col(f"tot_{s}") for s in sums] if totals else []),
    )
    return out


def asof_neighbours(knots: DataFrame, probes: DataFrame, keys: list[str], value: str,
                    payload: list[str], n_buckets: int | None = None) -> DataFrame:
    """For every probe row, the nearest knot at or below it and the nearest above.

    ``knots`` has ``keys + [value] + payload`` with ``value`` unique per key;
    ``probes`` has ``keys + [value]`` plus any columns.  Output: the probe
    columns plus ``lo_<value>``, ``lo_<p>``, ``hi_<value>``, ``hi_<p>`` (NULL
    when there is no knot on that side).  A knot equal to the probe is its
    ``lo`` neighbour (knots sort before probes on ties).
    """
    if n_buckets is None:
        n_buckets = default_buckets(knots.sparkSession)
    kb, kcols = _with_key(knots, keys)
    pb, _ = _with_key(probes, keys)
    if n_buckets > 1:
        bounds = F.broadcast(bucket_bounds(kb, kcols, value, n_buckets))
        kb = kb.join(bounds, kcols).withColumn(_B, bucket_of(F.col(value), F.col("__bounds"))).drop("__bounds")
        pb = pb.join(bounds, kcols, "left").withColumn(
            _B, F.coalesce(bucket_of(F.col(value), F.col("__bounds")), F.lit(0))).drop("__bounds")
    else:
        kb, pb = kb.withColumn(_B, F.lit(0)), pb.withColumn(_B, F.lit(0))

    knot = F.struct(F.col(value).alias("v"), *[F.col(p).alias(p) for p in payload])
    ktype = kb.select(knot.alias("k")).schema["k"].dataType
    pcols = [c for c in pb.columns if c not in kcols + [_B, value]]
    u = (kb.select(*kcols, _B, F.col(value), F.lit(0).alias("__is_probe"), knot.alias("__knot"),
                   *[F.lit(None).cast(pb.schema[c].dataType).alias(c) for c in pcols])
           .unionByName(pb.select(*kcols, _B, F.col(value), F.lit(1).alias("__is_probe"),
                                  F.lit(None).cast(ktype).alias("__knot"), *pcols)))
    # Both neighbours come from running frames (unbounded preceding .. current
    # row), which Spark evaluates in one pass; a frame reaching to unbounded
    # following is re-aggregated for every row (quadratic in the partition).
    # The knot above a probe is the last knot seen in descending order, where
    # probes sort before knots on ties (an equal knot is the lower neighbour).
    w = Window.partitionBy(*kcols, _B).orderBy(F.col(value), F.col("__is_probe"))
    wd = Window.partitionBy(*kcols, _B).orderBy(F.col(value).desc(), F.col("__is_probe").desc())
    u = u.select("*",
                 F.last("__knot", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__lo"),
                 F.last("__knot", ignorenulls=True).over(wd.rowsBetween(Window.unboundedPreceding, 0)).alias("__hi"))
    probe_part = u.filter(F.col("__is_probe") == 1)

    # Neighbours in other buckets: the last knot of the nearest lower bucket and
    # the first knot of the nearest higher one, from a (key, bucket) summary that
    # also lists buckets holding probes but no knot.
    kb_ends = kb.groupBy(*kcols, _B).agg(F.max_by(knot, F.col(value)).alias("__last"),
                                        F.min_by(knot, F.col(value)).alias("__first"))
    empty = (pb.select(*kcols, _B).distinct()
               .join(kb_ends.select(*kcols, _B), kcols + [_B], "left_anti")
               .select(*kcols, _B, F.lit(None).cast(ktype).alias("__last"), F.lit(None).cast(ktype).alias("__first")))
    wb = Window.partitionBy(*kcols).orderBy(_B)
    wbd = Window.partitionBy(*kcols).orderBy(F.col(_B).desc())
    ends = kb_ends.unionByName(empty).select(
        *kcols, _B,
        F.last("__last", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("__plast"),
        F.last("__first", ignorenulls=True).over(wbd.rowsBetween(Window.unboundedPreceding, -1)).alias("__nfirst"))
    res = probe_part.join(F.broadcast(ends), kcols + [_B], "left").select(
        "*", F.coalesce("__lo", "__plast").alias("__L"), F.coalesce("__hi", "__nfirst").alias("__H"))
    sel = [F.col(c) for c in kcols if c != _K] + [F.col(value)] + [F.col(c) for c in pcols]
    sel.append(F.col("__L.v").alias(f"lo_{value}"))
    sel += [F.col(f"__L.{p}").alias(f"lo_{p}") for p in payload]
    sel.append(F.col("__H.v").alias(f"hi_{value}"))
    sel += [F.col(f"__H.{p}").alias(f"hi_{p}") for p in payload]
    return res.select(*sel)
