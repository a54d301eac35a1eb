"""Rank normalisation of scores and piecewise-linear mapping of new scores.

* :func:`average_rank` - ``rank / (n + 1)`` with tied scores sharing the mean
  of their ranks; computed on distinct scores (ties collapse map-side) and
  joined back.
* :func:`ordinal_rank` - ``(position + 1) / (n + 1)`` in (score, id) order
  (the id breaks ties deterministically).
* :func:`interpolate` - maps probe scores onto the (score, rank) knots by
  linear interpolation between the neighbouring knots, clamped to the end
  knots outside their range; the neighbours come from an as-of lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raretide.operators.ordered import asof_neighbours, bucket_bounds, bucket_of, default_buckets, prefix_sums


def rank_knots(df: DataFrame, keys: list[str], score: str = "score", n_buckets: int | None = None) -> DataFrame:
    """``keys, score, rank``: average rank / (n + 1) per distinct score."""
    c = df.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("c"))
    run = prefix_sums(c, keys, [score], ["c"], n_buckets=n_buckets)
    avg = (run["cum_c"] - run["c"]) + (run["c"] + 1) / 2.0
    return run.select(*keys, score, (avg / (F.col("tot_c") + 1)).alias("rank"))


def average_rank(df: DataFrame, keys: list[str], score: str = "score", out: str = "rank_norm",
                 n_buckets: int | None = None) -> DataFrame:
    knots = rank_knots(df, keys, score, n_buckets).withColumnRenamed("rank", out)
    return df.join(knots, keys + [score], "left")


def ordinal_rank(df: DataFrame, keys: list[str], score: str = "score", id_col: str = "id",
                 out: str = "rank_norm", n_buckets: int | None = None) -> DataFrame:
    """Position by (score, id) over n + 1.

    A score that many rows share is cut into id ranges: the rows are counted per
    (score, id range), the running counts of these cells place each cell, and
    only a cell's rows are numbered in one task.  A NULL score has no rank.
    """
    n_buckets = default_buckets(df.sparkSession) if n_buckets is None else n_buckets
    key = "__rank_key"
    rows = df.withColumn(key, F.lit(0))
    kcols = [key, *keys]
    bounds = F.broadcast(bucket_bounds(rows, kcols, id_col, n_buckets))  # keys x ranges numbers
    rows = rows.join(bounds, kcols, "left").withColumn("__range", bucket_of(F.col(id_col), F.col("__bounds"))).drop("__bounds")
    cells = rows.groupBy(*kcols, score, "__range").agg(F.count(F.lit(1)).alias("c"))
    run = prefix_sums(cells, kcols, [score, "__range"], ["c"], n_buckets=n_buckets)
    run = run.select(*kcols, score, "__range", (F.col("cum_c") - F.col("c")).alias("__before"), "tot_c")
    own = F.row_number().over(Window.partitionBy(*kcols, score, "__range").orderBy(id_col))
    placed = rows.withColumn("__own", own).join(run, [*kcols, score, "__range"], "left")
    return placed.select(*df.columns, ((F.col("__before") + F.col("__own")) / (F.col("tot_c") + 1)).alias(out))


def interpolate(knots: DataFrame, probes: DataFrame, keys: list[str], score: str = "score",
                rank: str = "rank", out: str = "rank_norm", n_buckets: int | None = None) -> DataFrame:
    """``np.interp(probe, knot_scores, knot_ranks)`` for knots unique in score.

    The as-of lookup runs on the distinct probe scores (a score shared by
    many probe rows - a hot value - collapses map-side to one row), and the
    mapped value joins back on ``(keys, score)``; AQE's skew-join splits a
    hot score on that join.  A NULL probe maps to NULL.
    """
    k = knots.filter(F.col(score).isNotNull()).select(*keys, score, rank)
    distinct = probes.filter(F.col(score).isNotNull()).select(*keys, score).distinct()
    nb = asof_neighbours(k, distinct, keys, score, [rank], n_buckets)
    s0, s1, r0, r1 = (F.col(f"lo_{score}"), F.col(f"hi_{score}"), F.col(f"lo_{rank}"), F.col(f"hi_{rank}"))
    x = F.col(score)
    val = (F.when(s0.isNull(), r1)
            .when(s1.isNull(), r0)
            .when(x == s0, r0)
            .otherwise(r0 + (x - s0) * (r1 - r0) / (s1 - s0)))
    mapped = nb.select(*keys, score, val.alias(out))
    return probes.join(mapped, keys + [score], "left")


def ordinal_knots(scored: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """``(keys, score, first, last)``: the ordinal ranks over n + 1 that the rows of each distinct score span."""
    counts = scored.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(F.count(F.lit(1)).alias("c"))
    run = prefix_sums(counts, keys, [score], ["c"])
    over = F.col("tot_c") + 1
    return run.select(*keys, score, ((F.col("cum_c") - F.col("c") + 1) / over).alias("first"), (F.col("cum_c") / over).alias("last"))


def interpolate_ordinal(knots: DataFrame, probes: DataFrame, keys: list[str], score: str = "score", out: str = "rank_norm") -> DataFrame:
    """``np.interp`` over every row's (score, ordinal rank): a tied score maps to its last rank, gaps run from last to first."""
    distinct = probes.where(F.col(score).isNotNull()).select(*keys, score).distinct()
    nb = asof_neighbours(knots, distinct, keys, score, ["first", "last"])
    x, s0, s1 = F.col(score), F.col(f"lo_{score}"), F.col(f"hi_{score}")
    value = (F.when(s0.isNull(), F.col("hi_first")).when(s1.isNull() | (x == s0), F.col("lo_last"))
             .otherwise(F.col("lo_last") + (x - s0) * (F.col("hi_first") - F.col("lo_last")) / (s1 - s0)))
    return probes.join(nb.select(*keys, score, value.alias(out)), keys + [score], "left")
