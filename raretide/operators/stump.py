"""Exact class-weighted decision stumps, one per training split, from one ordered pass.

A stump sends ``x <= threshold`` to the left.  Of all columns and distinct values it
takes the split with the largest

    (w_pos^2 + n_neg^2) / (w_pos + n_neg), summed over both sides,

``w_pos`` being the positives times the class weight: the split that lowers the weighted
Gini impurity most.  The cells are counted by (column, value) with a counter per fold
and class, map-side; running sums of those counters in value order give, for every
split ``tf`` at once, the classes at or below a value as total less fold ``tf``.
Ties go to the earlier column, then the smaller threshold.

Nulls go right.  A split must leave rows on both sides; where none does (constant
columns, one row) every row gets the weighted rate of its split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raretide.operators.ordered import default_buckets, prefix_sums

#: Rows of a column in one value range of the ordered pass.
ROWS_PER_BUCKET = 1_000_000


@dataclass
class Stump:
    col: str | None
    threshold: float
    left: float
    right: float

    def score(self) -> Column:
        if self.col is None:
            return F.lit(self.right)
        return F.when(F.col(self.col).cast("double") <= F.lit(self.threshold), F.lit(self.left)).otherwise(F.lit(self.right))


def _rate(pos: Column, neg: Column, spw: float) -> Column:
    return F.lit(spw) * pos / (F.lit(spw) * pos + neg)


def _purity(pos: Column, neg: Column, spw: float) -> Column:
    w = F.lit(spw) * pos
    return (w * w + neg * neg) / (w + neg)


def split_candidates(folded: DataFrame, cols: list[str], k: int, spw: float, label: str = "target", fold_col: str = "fold",
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``(tf, place, threshold, gain, left_pos, left_neg, right_pos, right_neg)`` of every valid split of every training split."""
    counters = [f"{side}{f}" for f in range(k) for side in ("pos", "neg")]
    hit = {f"{side}{f}": (F.col(fold_col) == f) & (F.col(label) == y) for f in range(k) for side, y in (("pos", 1), ("neg", 0))}
    whole = folded.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(hit[c]).alias(c) for c in counters]).first()  # 2 k + 1 numbers
    cells = F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("double").alias("value")) for i, c in enumerate(cols)])
    long = folded.select(fold_col, label, F.explode(cells).alias("c")).select(fold_col, label, "c.place", "c.value")
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = long.groupBy("place", "value").agg(*[F.count_if(hit[c]).alias(c) for c in counters])
    # a column of many distinct values is cut into ranges by the rows, whatever the number of columns
    n_buckets = max(default_buckets(folded.sparkSession, len(cols)), -(-whole["n"] // rows_per_bucket))
    run = prefix_sums(counted, ["place"], ["value"], counters, n_buckets=n_buckets, totals=False,
                      tasks=max(default_buckets(folded.sparkSession), n_buckets * len(cols)))

    def side(tf: int) -> Column:
        left = {s: sum((F.col(f"cum_{s}{f}") for f in range(k) if f != tf), F.lit(0)) for s in ("pos", "neg")}
        all_ = {s: sum(int(whole[f"{s}{f}"]) for f in range(k) if f != tf) for s in ("pos", "neg")}
        right = {s: F.lit(all_[s]) - left[s] for s in left}
        valid = (left["pos"] + left["neg"] > 0) & (right["pos"] + right["neg"] > 0)
        gain = _purity(left["pos"], left["neg"], spw) + _purity(right["pos"], right["neg"], spw)
        return F.when(valid, F.struct(F.lit(tf).alias("tf"), gain.alias("gain"), left["pos"].alias("left_pos"), left["neg"].alias("left_neg"),
                                      right["pos"].alias("right_pos"), right["neg"].alias("right_neg")))

    out = run.select("place", F.col("value").alias("threshold"), F.explode(F.array_compact(F.array(*[side(tf) for tf in range(k)]))).alias("s"))
    return out.select("s.tf", "place", "threshold", "s.gain", "s.left_pos", "s.left_neg", "s.right_pos", "s.right_neg")


def fit_stumps(folded: DataFrame, cols: list[str], k: int, spw: float, label: str = "target", fold_col: str = "fold") -> dict[int, Stump]:
    """The best stump of every training split ``tf`` (rows outside fold ``tf``)."""
    splits = split_candidates(folded, cols, k, spw, label, fold_col)
    order = F.struct(-F.col("gain"), "place", "threshold")
    best = splits.groupBy("tf").agg(F.min_by(F.struct(*splits.columns), order).alias("b")).select("b.*")
    best = best.select("tf", "place", "threshold", _rate(F.col("left_pos"), F.col("left_neg"), spw).alias("left"),
                       _rate(F.col("right_pos"), F.col("right_neg"), spw).alias("right"))
    got = {r.tf: Stump(cols[r.place], r.threshold, r.left, r.right) for r in best.collect()}  # one row per split
    if len(got) < k:
        rates = folded.groupBy(fold_col).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).collect()
        for tf in range(k):
            p, n = (sum(r[c] for r in rates if r[fold_col] != tf) for c in ("p", "n"))
            got.setdefault(tf, Stump(None, 0.0, 0.0, spw * p / (spw * p + n) if p + n else 0.0))
    return got


def stump_scores(folded: DataFrame, test: DataFrame, cols: list[str], k: int, spw: float, label: str = "target",
                 fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Out-of-fold scores ``(id, fold, target, score)`` and the mean test scores ``(id, score)`` of the splits' stumps."""
    stumps = fit_stumps(folded, cols, k, spw, label, fold_col)
    own = F.coalesce(*[F.when(F.col(fold_col) == tf, s.score()) for tf, s in sorted(stumps.items())])
    oof = folded.select("id", F.col(fold_col).alias("fold"), F.col(label).alias("target"), own.alias("score"))
    total = sum((s.score() for _, s in sorted(stumps.items())), F.lit(0.0))
    return oof, test.select("id", (total / F.lit(float(k))).alias("score"))
