import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from raretide.operators import quantiles


def table(spark, n, seed=8):
    rnd = random.Random(seed)
    rows = [(rnd.gauss(0, 1), float(rnd.randint(0, 3)), 7.0, rnd.choice([None, rnd.expovariate(1), 0.0]), None, rnd.choice([float("nan"), rnd.random()]))
            for _ in range(n)]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(5)


@pytest.mark.parametrize("n, accuracy, most", [(1, 4000, 10), (7, 4000, 10), (3000, 4000, 10**6), (3000, 40, 10**6), (3000, 40, 60), (3000, 4000, 1)])
def test_column_quantiles_match_numpy(spark, n, accuracy, most):
    rows, df = table(spark, n)
    probs = [0.0, 0.01, 0.25, 0.5, 0.5001, 0.97, 1.0]
    got = {(r["col"], r["q_idx"]): r["quantile"] for r in quantiles.column_quantiles(df, df.columns, probs, accuracy=accuracy, most_inside=most).collect()}
    want = {}
    for j, c in enumerate(df.columns):
        values = [r[j] for r in rows if r[j] is not None and r[j] == r[j]]
        want.update({(c, i): v for i, v in enumerate(np.percentile(values, [100 * p for p in probs]))} if values else {})
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12) for k in want)


def test_keyed_quantiles_match_numpy(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["x", "y", None]), round(rnd.random(), 2) if i % 3 else rnd.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v double")
    for most, buckets in ((10**6, None), (5, 3)):
        got = {(r["k"], r["q_idx"]): r["quantile"] for r in quantiles.exact_quantiles(df, ["k"], "v", [0.1, 0.5, 0.99], buckets, 50, most).collect()}
        assert len(got) == 9
        for k in ("x", "y", None):
            want = np.percentile([v for kk, v in rows if kk == k], [10, 50, 99])
            assert [got[k, i] for i in range(3)] == pytest.approx(list(want))


def test_wrong_brackets_are_widened(spark, monkeypatch):
    rows, df = table(spark, 2000)
    honest = quantiles._first_brackets

    def lying(*args):
        sizes, tries = honest(*args)
        return sizes, {k: [[(1e9, 1e9 + 1), (-1e9, -1e9), *steps[1:]] for steps in ts] for k, ts in tries.items()}

    monkeypatch.setattr(quantiles, "_first_brackets", lying)
    got = [r["quantile"] for r in quantiles.column_quantiles(df, ["a"], [0.3, 0.8]).orderBy("q_idx").collect()]
    assert got == pytest.approx(list(np.percentile([r[0] for r in rows], [30, 80])))


def test_only_cells_inside_brackets_are_shipped(spark, tmp_path):
    """The shuffle holds gap counts and bracket cells, not the table's cells."""
    n = 200_000
    df = spark.range(n, numPartitions=4).select(*[(F.xxhash64("id", F.lit(i)) / 2.0**63).alias(f"c{i}") for i in range(5)])
    seen = []
    stored = quantiles._stored

    def counting(x):
        out = stored(x)
        seen.append(out.count())
        return out

    quantiles._stored, keep = counting, quantiles._stored
    try:
        quantiles.column_quantiles(df, df.columns, [0.5]).collect()
    finally:
        quantiles._stored = keep
    assert seen and max(seen) < 0.01 * n * 5


def test_no_rows_no_quantiles(spark):
    df = spark.createDataFrame([], "a double")
    assert quantiles.column_quantiles(df, ["a"], [0.5]).collect() == []


def test_tied_cells_are_counted_without_rows(spark, monkeypatch):
    """A bracket of one value is a plain sum: cells of 0/1 columns never become rows."""
    df = spark.range(4000, numPartitions=3).select(*[(F.col("id") % m == 0).cast("double").alias(f"c{m}") for m in (3, 5)])
    plans, stored = [], quantiles._stored
    monkeypatch.setattr(quantiles, "_stored", lambda d: plans.append(d._jdf.queryExecution().toString()) or stored(d))
    got = {r["col"]: r["quantile"] for r in quantiles.column_quantiles(df, df.columns, [0.5]).collect()}
    assert got == {"c3": 0.0, "c5": 0.0}
    assert plans and not any("explode" in p for p in plans)


def test_wide_counts_are_made_in_one_look_at_a_cell(spark, capfd):
    """Zones and counts of cells with nulls, ends at infinity and brackets of one value, without an expression per bracket."""
    rnd = random.Random(7)
    rows = [(rnd.choice([None, -1.0, 0.0, -0.0, 0.25, rnd.random()]), rnd.choice([float("inf"), 3.0, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b double")
    brackets = {("a",): [(float("-inf"), -1.0), (0.0, 0.0), (0.2, 0.4)], ("b",): [(3.0, 3.0), (5.0, float("inf"))]}
    want = {}
    for (c,), spans in brackets.items():
        for row in rows:
            x = row["ab".index(c)]
            if x is not None:
                zone = sum((x >= lo) + (x > hi) for lo, hi in spans)
                key = (c, zone, x if zone % 2 else None)
                want[key] = want.get(key, 0) + 1
    counted = quantiles._wide_counts(df, brackets)
    assert {(r.col, r.zone, r.value): r.n for r in counted.collect()} == want
    capfd.readouterr()
    counted.explain()
    assert "MapInArrow" in (plan := capfd.readouterr().out) and "explode" not in plan
