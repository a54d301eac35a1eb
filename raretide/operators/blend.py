"""Weight-grid blending of model scores, scored by a ranking metric.

Weights are integer points ``(i_1..i_m)`` with ``sum = steps`` (the simplex
at step ``1/steps``; for two models ``i_1`` runs 0..steps).

:func:`search` finds the exact best point without ordering the rows of every
point.  Each task counts its rows per (point, score bin); the summed histogram
of a point bounds its metric from below and above (worst and best order within
the bins).  Points whose upper bound is below the best lower bound cannot win
and go; the others are counted again in finer bins while that still removes
points, and what remains is scored exactly.  The histograms' size is points x
bins per task, whatever the number of rows, and no number of survivors is set.

:func:`grid_metric` scores every point exactly (a report of the whole grid) from counts
at the scores of the positives, so it does not order the rows of every point either.

The winner is the highest metric, first in grid order on ties (metrics
compared at 12 decimals so summation order cannot reorder true ties).
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raretide.operators.metrics import average_precision, roc_auc


def weight_names(n_models: int) -> list[str]:
    return [f"w{j + 1}" for j in range(n_models)]


# Rows of one grid point per value-range bucket on the search's exact path.
ROWS_PER_BUCKET = 1_000_000
# Rows and positives that a task of the whole grid's report holds.
CHUNK_ROWS, TILE_ROWS = 2_000_000, 2_000_000
# What such a task says of a point.
COUNTS = pa.schema({"tile": pa.int32(), "point": pa.int32(), "times": pa.binary(), "below": pa.binary(), "more": pa.binary()})
# Score bins of the first bounding pass, their growth per pass, and the most bytes of a task's counters.
FIRST_BINS, BIN_GROWTH, COUNTER_BYTES = 256, 8, 128 << 20


def blended(models: list[str], weights: list[str] | None = None) -> Column:
    weights = weights or weight_names(len(models))
    total = None
    for m, w in zip(models, weights):
        t = F.col(w).cast("double") * F.col(m)
        total = t if total is None else total + t
    return total


def grid_points(n_models: int, steps: int) -> list[tuple[int, ...]]:
    """All integer points ``(i_1..i_m)`` with ``sum = steps``, in grid order."""
    if n_models == 1:
        return [(steps,)]
    return [(i,) + rest for i in range(steps + 1) for rest in grid_points(n_models - 1, steps - i)]


def _order_keys(scores: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """Longs in the order that Spark sorts the scores in: nulls first, NaN last, equal scores equal; made in place of the scores."""
    last = np.isnan(scores)
    scores += 0.0
    keys = scores.view(np.int64)
    np.bitwise_xor(keys, np.int64(np.iinfo(np.int64).max), out=keys, where=keys < 0)
    keys[last] = np.iinfo(np.int64).max
    keys[missing] = np.iinfo(np.int64).min
    return keys


def _packed(running: np.ndarray) -> bytes:
    """Ascending counts as the compressed steps between them, in as few bytes a step as hold the largest."""
    steps = np.diff(running, prepend=0)
    small = np.min_scalar_type(int(steps.max(initial=0)))
    return small.char.encode() + zlib.compress(steps.astype(small).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed[1:]), dtype=packed[:1].decode()), dtype=np.int64)


def grid_metric(wide: DataFrame, models: list[str], steps: int, metric: str = "ap", label: str = "target",
                chunk_rows: int = CHUNK_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``w1..wm, metric`` for every grid point, exactly, without a row per row and point.

    Both metrics need, at the score of every positive, how many rows of either class lie below (and at) it.
    Rows are dealt into chunks, positives into tiles; a task holds one of each and a block of
    points, sorts the chunk's scores of a point and counts them at the tile's distinct
    scores.  A point's counts leave the task before the next point is counted.  What is shuffled per
    point is these counts, as small steps, one per positive and chunk; they are summed by
    (tile, point) and the tiles' shares of the metric are added.
    """
    spark, names, points = wide.sparkSession, weight_names(len(models)), grid_points(len(models), steps)
    no = functools.reduce(lambda a, b: a | b, [F.col(m).isNull() for m in models])
    base = wide.select((F.col(label) == 1).alias("__y"), no.alias("__no"), *[F.col(m).cast("double").alias(f"__m{j}") for j, m in enumerate(models)])
    base = base.withColumn("__y", F.coalesce("__y", F.lit(False)))
    n, n_pos = base.agg(F.count("*"), F.count_if("__y")).first()
    chunks, tiles = max(1, -(-n // chunk_rows)), max(1, -(-n_pos // tile_rows))
    blocks = min(len(points), -(-2 * spark.sparkContext.defaultParallelism // (chunks * tiles)))
    columns = [f"__m{j}" for j in range(len(models))]
    spread = functools.partial(F.pmod, F.xxhash64("__y", *columns, F.monotonically_increasing_id()))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def dealt(rows: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        rows = rows.select("*", spread(F.lit(count)).cast("int").alias(own))
        return rows.select("*", every(others).alias(other)).select("*", every(blocks).alias("block"))

    keys = ["chunk", "tile", "block"]
    rows = dealt(base, "chunk", chunks, "tile", tiles).withColumn("held", F.lit(True))
    positives = dealt(base.where("__y"), "tile", tiles, "chunk", chunks).withColumn("held", F.lit(False))
    both = rows.unionByName(positives)
    inside = metric == "ap" and tiles == 1  # a tile of all positives knows how many lie below

    def scored(parts: list[list[np.ndarray]]) -> Callable[[tuple[int, ...]], np.ndarray]:
        values = [np.concatenate([p.pop() for p in parts]) for _ in columns][::-1]  # a column's pieces go as it is made
        missing = np.concatenate([p.pop() for p in parts])
        return lambda point: _order_keys(_blend_values(values, point), missing)

    def count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: list[list[list[np.ndarray]]] = [[], [], []]  # negatives and positives of the chunk, positives of the tile
        for batch in batches:
            held, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("held", "__y"))
            values = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("__no", *columns)]
            for side, mask in zip(sides, (held & ~y, held & y, ~held)):
                side.append([np.asarray(v[mask], dtype=np.float64 if i else bool) for i, v in enumerate(values)])
        if not sum(len(p[0]) for p in sides[0] + sides[1]) or not sum(len(p[0]) for p in sides[2]):
            return
        neg_at, pos_at, tile_at = map(scored, sides)
        for i in range(key[2].as_py(), len(points), blocks):
            at, times = np.unique(tile_at(points[i]), return_counts=True)
            neg = neg_at(points[i])
            neg.sort()
            below = np.searchsorted(neg, at, "left")
            more = b"" if inside else _packed(np.searchsorted(neg, at, "right") if metric == "auc" else np.searchsorted(np.sort(pos_at(points[i])), at, "left"))
            # one point at a time leaves the task: a block's counts are many times the rows
            yield pa.RecordBatch.from_pydict({"tile": [key[1].as_py()], "point": [i], "times": [_packed(np.cumsum(times))], "below": [_packed(below)], "more": [more]}, COUNTS)

    def share(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        reached = _unpacked(group["times"].iloc[0])
        times = np.diff(reached, prepend=0)
        below = functools.reduce(np.add, map(_unpacked, group["below"]))
        more = reached - times if inside else functools.reduce(np.add, map(_unpacked, group["more"]))
        if metric == "auc":  # negatives below, and those below or at the score
            part = float((times * (below + (more - below) / 2.0)).sum())
        else:  # negatives and positives below: the rest of the table is at or above the score
            hits = n_pos - more
            part = float((times * (hits / (hits + (n - n_pos - below)))).sum())
        return pd.DataFrame({"point": [int(key[1])], "part": [part]})

    counted = both.groupBy(*keys).applyInArrow(count, "tile int, point int, times binary, below binary, more binary")
    shares = counted.groupBy("tile", "point").applyInPandas(share, "point int, part double").groupBy("point").agg(F.sum("part").alias("part"))
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "point int, " + ", ".join(f"{w} int" for w in names))
    whole = float(n_pos) if metric == "ap" else float(n_pos) * float(n - n_pos)
    exact = F.try_divide(F.col("part"), F.lit(whole)).alias("metric")
    return table.where(F.lit(n > 0)).join(shares, "point", "left").select(*names, exact)


def _blend_values(columns: list[np.ndarray], point: tuple[int, ...]) -> np.ndarray:
    """The same sum in the same order as :func:`blended`, so that both order the rows alike."""
    total = float(point[0]) * columns[0]
    for w, c in zip(point[1:], columns[1:]):
        total += float(w) * c
    return total


def _bounds(pos: np.ndarray, n: np.ndarray, metric: str) -> tuple[float, float]:
    """Least and greatest metric that a histogram (ascending score bins) allows."""
    pos, n = pos[::-1].astype(np.float64), n[::-1].astype(np.float64)
    neg = n - pos
    if metric == "auc":
        below = neg.sum() - np.cumsum(neg)
        pairs = max(1.0, pos.sum() * neg.sum())
        sure = float((pos * below).sum())
        return sure / pairs, (sure + float((pos * neg).sum())) / pairs
    p0, n0 = np.cumsum(pos) - pos, np.cumsum(n) - n
    some = pos > 0
    p, q, a, b = pos[some], neg[some], p0[some], n0[some]
    high = p * (a + p) / (b + p)
    # negatives first: the sum of (a + i) / (b + q + i) over i = 1..p
    start = b + q
    loss = (a - start) * np.where(start > 0, np.log1p(p / np.maximum(start, 1e-300)), 0.0)
    low = np.maximum(p + loss, p * (a + 1) / (start + 1))
    whole = max(1.0, pos.sum())
    return float(low.sum()) / whole, float(high.sum()) / whole


def metric_bounds(wide: DataFrame, models: list[str], points: list[tuple[int, ...]], bins: int, ends: list[tuple[float, float]],
                  metric: str, label: str = "target") -> list[tuple[float, float]]:
    """(least, greatest) metric of every point, from one histogram of ``bins`` score bins per point and task."""
    spans = [(sum(w * lo for w, (lo, _) in zip(p, ends)), sum(w * hi for w, (_, hi) in zip(p, ends))) for p in points]
    parts = max(1, len(points) // 64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((len(points), 2 * bins), dtype=np.int64)
        for b in batches:
            columns, y = [b[m].to_numpy(dtype=np.float64) for m in models], b[label].to_numpy(dtype=np.int64)
            for i, p in enumerate(points):
                lo, hi = spans[i]
                at = np.clip((_blend_values(columns, p) - lo) * (bins / (hi - lo)) if hi > lo else np.zeros(len(y)), 0, bins - 1)
                table[i] += np.bincount(2 * at.astype(np.int64) + y, minlength=2 * bins)
        for i, row in enumerate(table):
            at = np.flatnonzero(row)
            if len(at):
                yield pd.DataFrame({"part": [i % parts], "point": [i], "at": [at.astype(np.int32).tobytes()], "n": [row[at].tobytes()]})

    def bound(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i, rows in group.groupby("point"):
            total = np.zeros(2 * bins, dtype=np.int64)
            for at, n in zip(rows["at"], rows["n"]):
                total[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.int64)
            out.append((i, *_bounds(total[1::2], total[::2] + total[1::2], metric)))
        return pd.DataFrame(out, columns=["point", "low", "high"])

    counts = wide.select(label, *models).mapInPandas(count, "part int, point int, at binary, n binary")
    rows = counts.groupBy("part").applyInPandas(bound, "point int, low double, high double").collect()  # one row per point
    got = {r.point: (r.low, r.high) for r in rows}
    return [got.get(i, (0.0, 0.0)) for i in range(len(points))]


def surviving_points(wide: DataFrame, models: list[str], steps: int, metric: str = "ap", label: str = "target",
                     first_bins: int = FIRST_BINS, ends: list[tuple[float, float]] | None = None) -> list[tuple[int, ...]]:
    """Every grid point that the bounds do not rule out as the best.

    Bins grow while that rules points out and the counters (two per point and bin) stay
    within ``COUNTER_BYTES`` a task; ``ends`` are the models' least and greatest scores.
    """
    points, bins = grid_points(len(models), steps), first_bins
    ends = score_ends(wide, models)[1] if ends is None else ends
    if not ends:
        return points[:1]
    while len(points) > 1:
        bounds = metric_bounds(wide, models, points, bins, ends, metric, label)
        best = max(low for low, _ in bounds)
        left = [p for p, (_, high) in zip(points, bounds) if high >= best - 1e-9]
        wider = min(bins * BIN_GROWTH, COUNTER_BYTES // (16 * len(left)))
        if len(left) == len(points) or wider <= bins:
            return left
        points, bins = left, wider
    return points


def score_ends(wide: DataFrame, models: list[str]) -> tuple[int, list[tuple[float, float]]]:
    """(rows, least and greatest score of every model; none without rows), in one pass."""
    row = wide.agg(F.count("*"), *[f(m) for m in models for f in (F.min, F.max)]).first()
    return row[0], [] if row[1] is None else [(float(row[1 + 2 * i]), float(row[2 + 2 * i])) for i in range(len(models))]


def best_weights(grid: DataFrame, n_models: int) -> DataFrame:
    names = weight_names(n_models)
    return grid.orderBy(F.round("metric", 12).desc(), *[F.col(n).asc() for n in names]).limit(1)


def search(wide: DataFrame, models: list[str], steps: int, metric: str = "ap", label: str = "target") -> DataFrame:
    """The best grid point, ``w1..wm, metric``: bounds first, then exact scores of the survivors."""
    names = weight_names(len(models))
    n, ends = score_ends(wide, models)
    left = surviving_points(wide, models, steps, metric, label, ends=ends)
    points = F.array(*[F.struct(*[F.lit(int(w)).alias(n) for n, w in zip(names, p)]) for p in left])
    rows = wide.select(label, *models, F.explode(points).alias("__w")).select(label, *models, "__w.*")
    fn = average_precision if metric == "ap" else roc_auc
    exact = fn(rows.select(*names, label, blended(models, names).alias("blend")), names, "blend", label,
               n_buckets=max(1, -(-n // ROWS_PER_BUCKET)), alias="metric")
    return best_weights(exact, len(models))


def apply_weights(wide: DataFrame, models: list[str], weights: list[float], out: str = "blend") -> DataFrame:
    """``sum w_j * s_j`` with the chosen (fractional) weights."""
    total = None
    for m, w in zip(models, weights):
        t = F.lit(float(w)) * F.col(m)
        total = t if total is None else total + t
    return wide.withColumn(out, total)


def pivot_scores(long: DataFrame, models: list[str], keys: list[str], model_col: str = "model",
                 score: str = "score") -> DataFrame:
    """``(keys, model, score)`` rows to one row per key with a column per model."""
    return long.groupBy(*keys).pivot(model_col, models).agg(F.first(score))
