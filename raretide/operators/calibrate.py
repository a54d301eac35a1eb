"""Isotonic calibration: fit on out-of-fold scores, apply to any scores.

The least-squares increasing fit of labels on scores is the slope of the lower convex
hull of the cumulative sums (rows, labels) in score order, and hulls can be merged: the
hull of two neighbouring score ranges is the hull of their hulls.  So

1. rows of one score are counted together, map-side (a hot score is one row);
2. the scores are cut into ranges, and every range reduces to the edges of its own
   hull (blocks of scores with rising label rates);
3. neighbouring ranges merge, ``FAN`` at a time, in a tree of tasks until one hull is
   left: the steps of the fitted function.

A hull of n rows with whole-numbered labels has at most about n^(2/3) edges (distinct
fractions of that total), usually far fewer, so what meets in the last task is the
fitted function and little else.

The function runs linearly between the blocks' ends and is constant beyond the first
and last score.  It is applied by an as-of join with its knots, itself cut by score.

Null scores or labels are left out of the fit; a null score maps to null; a fit without
rows maps everything to null.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raretide.operators.ordered import bucket_bounds, bucket_of
from raretide.operators.ranknorm import interpolate

#: Distinct scores of a range, and ranges that merge in one task.
RANGE_SCORES = 100_000
FAN = 8

_BLOCK = "range int, x0 double, x1 double, n long, s double"


@dataclass
class IsotonicModel:
    """``blocks(x0, x1, n, s)``: score ranges with rising label rate s / n."""

    blocks: DataFrame

    def knots(self) -> DataFrame:
        """``(score, calibrated)``: both ends of every block."""
        ends = F.array_distinct(F.array("x0", "x1"))
        return self.blocks.select(F.explode(ends).alias("score"), (F.col("s") / F.col("n")).alias("calibrated"))


def hull_edges(x0: list[float], x1: list[float], n: list[int], s: list[float]) -> list[tuple[float, float, int, float]]:
    """Edges of the lower hull of blocks in score order: neighbours merge until the rates s / n rise."""
    out: list[tuple[float, float, int, float]] = []
    for lo, hi, m, t in zip(x0, x1, n, s):
        while out and out[-1][3] * m >= t * out[-1][2]:
            lo, m, t = out[-1][0], m + out[-1][2], t + out[-1][3]
            out.pop()
        out.append((lo, hi, m, t))
    return out


def merge_ranges(blocks: DataFrame, fan: int) -> DataFrame:
    """The hulls of ``fan`` neighbouring ranges each, as one range."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("x0")
        edges = hull_edges(*[group[c].tolist() for c in ("x0", "x1", "n", "s")])
        out = pd.DataFrame(edges, columns=["x0", "x1", "n", "s"])
        out.insert(0, "range", int(group["range"].iloc[0]) // fan)
        return out

    return blocks.groupBy(F.floor(F.col("range") / fan)).applyInPandas(run, _BLOCK)


def fit_isotonic(oof: DataFrame, score: str = "score", label: str = "target", range_scores: int = RANGE_SCORES, fan: int = FAN) -> IsotonicModel:
    x, y = F.col(score).cast("double"), F.col(label).cast("double")
    points = oof.select(x.alias("x0"), y.alias("y")).where("x0 is not null and y is not null")
    points = points.groupBy("x0").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    distinct = oof.select(F.approx_count_distinct(x)).first()[0]
    ranges = max(1, -(-int(distinct) // range_scores))
    if ranges > 1:
        bounds = bucket_bounds(points.withColumn("k", F.lit(0)), ["k"], "x0", ranges)  # one row of as many numbers
        points = points.withColumn("k", F.lit(0)).join(F.broadcast(bounds), "k").withColumn("range", bucket_of(F.col("x0"), F.col("__bounds")).cast("int"))
    else:
        points = points.withColumn("range", F.lit(0))
    blocks = merge_ranges(points.select("range", "x0", F.col("x0").alias("x1"), "n", "s"), 1)
    while ranges > 1:
        blocks, ranges = merge_ranges(blocks, fan), -(-ranges // fan)
    return IsotonicModel(blocks.select("x0", "x1", "n", "s"))


def apply_isotonic(model: IsotonicModel, df: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
    knots = model.knots().select(F.lit(0).alias("__k"), F.col("score").alias(score), F.col("calibrated").alias("rank"))
    probes = df.withColumn("__k", F.lit(0)).withColumn(score, F.col(score).cast("double"))
    return interpolate(knots, probes, ["__k"], score, "rank", out).select(*df.columns, out)
