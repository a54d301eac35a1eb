import random

import numpy as np
import pytest

from raretide.operators import calibrate


def min_max(xs, ys):
    """The increasing fit at every distinct score by its min-max formula."""
    points = sorted(set(xs))
    n = np.array([sum(x == p for x in xs) for p in points], dtype=float)
    s = np.array([sum(y for x, y in zip(xs, ys) if x == p) for p in points], dtype=float)
    cn, cs = np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(s)))
    fit = [max(min((cs[j] - cs[i]) / (cn[j] - cn[i]) for j in range(k + 1, len(points) + 1)) for i in range(k + 1)) for k in range(len(points))]
    return points, fit


@pytest.mark.parametrize("range_scores, fan", [(10**6, 8), (20, 2), (7, 3), (1, 2)])
def test_merged_hulls_equal_min_max(spark, range_scores, fan):
    rnd = random.Random(range_scores)
    rows = []
    for i in range(400):
        x = rnd.choice([round(rnd.random(), 1), round(rnd.random(), 3)])
        rows.append((i, x, int(rnd.random() < x * x), "clash"))
    rows += [(900, None, 1, ""), (901, 0.5, None, "")] + [(902, 0.25, 1, "")] * 60  # a hot score
    df = spark.createDataFrame(rows, "id long, score double, target int, calibrated_by string").repartition(4)
    model = calibrate.fit_isotonic(df, range_scores=range_scores, fan=fan)
    points, fit = min_max(*zip(*[(x, y) for _, x, y, _ in rows if x is not None and y is not None]))
    probes = spark.createDataFrame([(i, float(p)) for i, p in enumerate([*points, -1.0, 2.0, *np.linspace(0, 1, 37)])] + [(5000, None)], "id long, score double")
    got = {r.id: r.calibrated for r in calibrate.apply_isotonic(model, probes).collect()}
    for i, p in enumerate([*points, -1.0, 2.0, *np.linspace(0, 1, 37)]):
        assert got[i] == pytest.approx(float(np.interp(p, points, fit)), abs=1e-12)
    assert got[5000] is None and len(got) == len(points) + 40
    rates = [r.s / r.n for r in model.blocks.orderBy("x0").collect()]
    assert rates == sorted(rates) and len(set(rates)) == len(rates)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, score double, target int")
    probes = spark.createDataFrame([(1, 0.5)], "id long, score double")
    assert [r.calibrated for r in calibrate.apply_isotonic(calibrate.fit_isotonic(df), probes).collect()] == [None]
