"""Exact quantiles (linear interpolation) by bracketed selection.

The exact ``percentile`` aggregate keeps every distinct value of a group in one
buffer, and an exact order statistic by sorting ships every cell.  Here a column
is read twice and almost nothing is shipped:

1. one approximate sketch per group gives, for every wanted quantile, a bracket of
   values a few sketch errors wide around it;
2. the second pass counts, by map-side aggregation, the cells of every gap between
   brackets as one number each and keeps only the cells inside a bracket, as
   distinct values with counts (columns of a table are counted side by side, so a
   cell becomes a row only inside a bracket of several values);
3. the counts say which positions each bracket covers.  A wanted position outside
   its bracket widens it, a bracket that holds too many distinct values is narrowed by
   a sketch of its own cells; the second pass is then run again;
4. running counts within each bracket give the wanted positions, and
   ``lo + (pos - floor) * (hi - lo)`` the quantile.

Same answer as ``numpy.percentile(..., method="linear")`` and DuckDB
``quantile_cont``.  Nulls and NaN are missing; a group without a value gives no row.
What the driver sees is the brackets and their counts: groups x quantiles numbers.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raretide.operators.ordered import prefix_sums
from raretide.session import checkpoint_root

#: Rank accuracy of a sketch (the first bracket reaches two errors to either side), the wider half widths of a
#: bracket that are tried next (shares of the cells), and the most distinct values of a bracket that is not narrowed.
ACCURACY = 4000
WIDER = (0.02, 0.25, 1.0)
MOST_INSIDE = 2_000_000

Brackets = dict[tuple, list[tuple[float, float]]]


def _zone(value: Column, brackets: list[tuple[float, float]]) -> Column:
    """2 i + 1 inside bracket i, 2 i in the gap before it; brackets ascend and are disjoint."""
    parts = [(value >= F.lit(lo)).cast("int") + (value > F.lit(hi)).cast("int") for lo, hi in brackets]
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def _merged(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _sketches(cells: DataFrame, keys: list[str], probs: list[float], accuracy: int) -> dict[tuple, tuple[int, list[float]]]:
    """(cells, values at ``probs``) of every group."""
    rows = cells.groupBy(*keys).agg(F.count("value").alias("n"), F.percentile_approx("value", probs, accuracy).alias("at")).collect()
    return {tuple(r[k] for k in keys): (r["n"], list(r["at"])) for r in rows if r["n"]}


def _wide_sketches(narrow: DataFrame, probs: list[float], accuracy: int) -> dict[tuple, tuple[int, list[float]]]:
    """:func:`_sketches` of every column, in one aggregate of the rows as they stand."""
    aggs = [a for i, c in enumerate(narrow.columns) for a in (F.count(F.col(c)).alias(f"n{i}"), F.percentile_approx(F.col(c), probs, accuracy).alias(f"at{i}"))]
    row = narrow.agg(*aggs).first()
    return {(c,): (row[f"n{i}"], list(row[f"at{i}"])) for i, c in enumerate(narrow.columns) if row[f"n{i}"]}


def _wide_counts(narrow: DataFrame, brackets: Brackets) -> DataFrame:
    """``(col, zone, value, n)``: a task adds up its gaps; only the distinct cells inside brackets become rows."""
    ends = {c: (np.array([lo for lo, _ in spans]), np.array([hi for _, hi in spans])) for (c,), spans in brackets.items()}

    def rows(c: str, zone: np.ndarray, value: np.ndarray | list, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c] * len(n), pa.string()), pa.array(zone, pa.int32()), pa.array(value, pa.float64()), pa.array(n, pa.int64())],
                                          ["col", "zone", "value", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = {c: np.zeros(len(los) + 1, dtype=np.int64) for c, (los, _) in ends.items()}
        for batch in batches:
            for c, (los, his) in ends.items():
                x = batch.column(c).drop_null().to_numpy()
                zone = np.searchsorted(los, x, "right") + np.searchsorted(his, x, "left")
                gaps[c] += np.bincount(zone, minlength=2 * len(los) + 1)[::2]
                inside = zone % 2 == 1
                if inside.any():
                    value, first, n = np.unique(x[inside], return_index=True, return_counts=True)  # a value lies in one bracket
                    yield rows(c, zone[inside][first], value, n)
        for c, n in gaps.items():
            some = np.flatnonzero(n)
            if len(some):
                yield rows(c, 2 * some, [None] * len(some), n[some])

    counted = narrow.select(*ends).mapInArrow(count, "col string, zone int, value double, n long")
    return counted.groupBy("col", "zone", "value").agg(F.sum("n").alias("n"))


def _first_brackets(sketches: Callable[[list[float]], dict], probs: list[float], accuracy: int) -> tuple[dict[tuple, int], dict[tuple, list[list[tuple[float, float]]]]]:
    """Cells of every group, and for each wanted quantile its brackets from narrow to whole."""
    widths = (2.0 / accuracy, *WIDER)
    asked = [min(1.0, max(0.0, q + s * w)) for q in probs for w in widths for s in (-1, 1)]
    sizes, out = {}, {}
    for key, (n, at) in sketches(asked).items():
        sizes[key], it = n, iter(at)
        out[key] = []
        for q in probs:
            steps = []
            for w in widths:
                lo, hi = next(it), next(it)
                if w * n >= 2:
                    steps.append((-math.inf if q - w <= 0 else lo, math.inf if q + w >= 1 else hi))
            out[key].append([*steps, (-math.inf, math.inf)])
    return sizes, out


def _select(count: Callable[[Brackets], DataFrame], sketch: Callable[[Brackets, list[float]], dict], keys: list[str], sizes: dict[tuple, int],
            tries: dict[tuple, list[list[tuple[float, float]]]], probs: list[float], accuracy: int, most_inside: int) -> tuple[DataFrame, dict[tuple, list[int]]]:
    """(counted cells, cells below each bracket) such that every wanted position lies inside a bracket."""
    spans = {k: [steps[0] for steps in ts] for k, ts in tries.items()}
    level = {(k, i): 0 for k in tries for i in range(len(probs))}
    settled: set[tuple] = set()  # quantiles that a narrowed bracket missed: not narrowed again
    narrowed: dict[tuple, int] = {}  # cells of the bracket that was narrowed last: it has to shrink
    while True:
        brackets = {k: _merged(s) for k, s in spans.items()}
        cells = count(brackets)
        zones: dict[tuple, dict[int, tuple[int, int]]] = {}
        for r in cells.groupBy(*keys, "zone").agg(F.sum("n").alias("n"), F.count("value").alias("distinct")).collect():
            zones.setdefault(tuple(r[k] for k in keys), {})[r["zone"]] = (int(r["n"]), int(r["distinct"]))
        below, widen, shares = {}, False, {}
        for k, bs in brackets.items():
            got, total, below[k] = zones[k], 0, []
            for b in range(len(bs)):
                total += got.get(2 * b, (0, 0))[0]
                below[k].append(total)
                total += got.get(2 * b + 1, (0, 0))[0]
            for i, q in enumerate(probs):
                b = max(j for j, (a, _) in enumerate(bs) if a <= spans[k][i][0])
                first, (inside, distinct) = below[k][b], got.get(2 * b + 1, (0, 0))
                wanted = q * (sizes[k] - 1)
                if math.floor(wanted) < first or math.ceil(wanted) >= first + inside:
                    settled |= {(k, i)} & narrowed.keys()
                    level[k, i] = min(level[k, i] + ((k, i) not in narrowed), len(tries[k][i]) - 1)
                    spans[k][i], widen = tries[k][i][level[k, i]], True
                elif distinct > most_inside and (k, i) not in settled and inside < narrowed.get((k, i), inside + 1):
                    narrowed[k, i] = inside
                    shares[k, i] = (2 * b + 1, (wanted - first) / max(1, inside - 1))
        if not widen and not shares:
            return cells, below
        narrow = 2.0 / accuracy
        ends = {ki: (max(0.0, p - narrow), min(1.0, p + narrow)) for ki, (_, p) in shares.items()}
        inner = sketch(brackets, sorted({p for pair in ends.values() for p in pair}))
        for (k, i), (lo, hi) in ends.items():
            values = inner[(*k, shares[k, i][0])]
            spans[k][i] = (values[lo], values[hi])


def _stored(df: DataFrame) -> DataFrame:
    path = f"{checkpoint_root(df.sparkSession)}/quantiles/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _run(cells: DataFrame, zoned: Callable[[Brackets], DataFrame], keys: list[str], probs: list[float], accuracy: int, most_inside: int,
         n_buckets: int = 1, wide: DataFrame | None = None) -> DataFrame:
    """Quantile rows from ``cells(keys..., value)``; ``zoned(brackets)`` has a column ``zone`` besides.

    ``wide`` holds the same cells as columns, the keys being their names.
    """
    spark = cells.sparkSession
    sizes, tries = _first_brackets(lambda asked: _sketches(cells, keys, asked, accuracy) if wide is None else _wide_sketches(wide, asked, accuracy),
                                   probs, accuracy)
    types = {c: t for c, t in cells.dtypes}
    empty = spark.createDataFrame([], ", ".join([f"`{k}` {types[k]}" for k in keys] + ["q_idx int", "q double", "quantile double"]))
    if not sizes:
        return empty

    def count(brackets: Brackets) -> DataFrame:
        if wide is not None:
            return _stored(_wide_counts(wide, brackets))
        inside = F.when(F.col("zone") % 2 == 1, F.col("value"))
        return _stored(zoned(brackets).groupBy(*keys, "zone", inside.alias("value")).agg(F.count(F.lit(1)).alias("n")))

    def sketch(brackets: Brackets, asked: list[float]) -> dict:
        if not asked:
            return {}
        found = _sketches(zoned(brackets).where("zone % 2 = 1"), [*keys, "zone"], asked, accuracy)
        return {k: dict(zip(asked, at)) for k, (_, at) in found.items()}

    counted, below = _select(count, sketch, keys, sizes, tries, probs, accuracy, most_inside)
    starts = [(*k, 2 * b + 1, n, sizes[k]) for k, ns in below.items() for b, n in enumerate(ns)]
    starts = [(*row, number) for number, row in enumerate(starts)]
    offsets = spark.createDataFrame(starts, ", ".join([f"`{k}` {types[k]}" for k in keys] + ["zone int", "below long", "size long", "bracket int"]))
    # groups x quantiles rows, fixed by parameters
    held = counted.where(F.col("zone") % 2 == 1)
    same = reduce(lambda a, b: a & b, [held[k].eqNullSafe(offsets[k]) for k in keys], held["zone"] == offsets["zone"])
    held = held.join(F.broadcast(offsets), same).select(*[held[k] for k in keys], "bracket", "value", "n", "below", "size")
    held = prefix_sums(held, ["bracket"], ["value"], ["n"], n_buckets=n_buckets, totals=False)
    held = held.withColumn("end", F.col("below") + F.col("cum_n")).withColumn("start", F.col("end") - F.col("n"))
    wanted = F.array(*[F.struct(F.lit(i).alias("q_idx"), F.lit(float(q)).alias("q")) for i, q in enumerate(probs)])

    def covered(at: Column) -> Column:
        return (at >= F.col("start")) & (at < F.col("end"))

    def place(t: Column) -> Column:
        return t["q"] * (F.col("size") - 1)

    hits = F.filter(wanted, lambda t: covered(F.floor(place(t))) | covered(F.ceil(place(t))))
    hits = held.select(*keys, "value", "start", "end", "size", F.explode(hits).alias("t"))
    at = place(F.col("t"))
    low, high = F.when(covered(F.floor(at)), F.col("value")), F.when(covered(F.ceil(at)), F.col("value"))
    out = hits.groupBy(*keys, "t.q_idx", "t.q").agg(F.max(low).alias("low"), F.max(high).alias("high"), F.first(at).alias("at"))
    return out.select(*keys, "q_idx", "q", (F.col("low") + (F.col("at") - F.floor("at")) * (F.col("high") - F.col("low"))).alias("quantile"))


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], n_buckets: int | None = None,
                    accuracy: int = ACCURACY, most_inside: int = MOST_INSIDE) -> DataFrame:
    """Rows ``keys..., q_idx, q, quantile``, one per key and probability; the number of keys is fixed by parameters.

    ``n_buckets`` cuts the running counts of a bracket into value ranges (one by default).
    """
    if not keys:
        return exact_quantiles(df.withColumn("__qk", F.lit(0)), ["__qk"], value, probs, n_buckets, accuracy, most_inside).drop("__qk")
    cells = df.select(*keys, _number(value).alias("value")).where("value is not null")
    types = dict(cells.dtypes)

    def zoned(brackets: Brackets) -> DataFrame:
        rows = [(*k, [lo for lo, _ in b], [hi for _, hi in b]) for k, b in brackets.items()]
        table = df.sparkSession.createDataFrame(rows, ", ".join([f"`{k}` {types[k]}" for k in keys] + ["los array<double>", "his array<double>"]))
        same = reduce(lambda a, b: a & b, [cells[k].eqNullSafe(table[k]) for k in keys])
        above = F.aggregate("los", F.lit(0), lambda t, x: t + (F.col("value") >= x).cast("int"))
        past = F.aggregate("his", F.lit(0), lambda t, x: t + (F.col("value") > x).cast("int"))
        return cells.join(F.broadcast(table), same).select(*[cells[k] for k in keys], "value", (above + past).alias("zone"))

    return _run(cells, zoned, list(keys), probs, accuracy, most_inside, n_buckets or 1)


def approx_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                     accuracy: int = 10000) -> DataFrame:
    agg = df.groupBy(*keys).agg(F.percentile_approx(F.col(value).cast("double"), probs, accuracy).alias("qs"))
    return agg.select(*keys, F.posexplode("qs").alias("q_idx", "quantile")).select(
        *keys, "q_idx", F.element_at(F.array(*[F.lit(float(q)) for q in probs]), F.col("q_idx") + 1).alias("q"),
        "quantile")


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True, accuracy: int = ACCURACY,
                     most_inside: int = MOST_INSIDE) -> DataFrame:
    """Quantiles of several columns: ``col, q_idx, q, quantile``, all columns in the same passes."""
    narrow = df.select(*[_number(c).alias(c) for c in cols])
    if not exact:
        return approx_quantiles(narrow.unpivot([], cols, "col", "value"), ["col"], "value", probs)

    def long(brackets: Brackets | None) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("col"), F.col(c).alias("value"), (_zone(F.col(c), brackets.get((c,), [])) if brackets else F.lit(0)).alias("zone"))
                 for c in cols]
        return narrow.select(F.explode(F.array(*cells)).alias("c")).select("c.col", "c.value", "c.zone").where("value is not null")

    return _run(long(None).select("col", "value"), long, ["col"], probs, accuracy, most_inside, wide=narrow)
