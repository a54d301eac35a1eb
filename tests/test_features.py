"""Row features on hand tables (expected values written by hand) and preset widths."""

import math

import pytest
from pyspark.sql import functions as F

from raretide.functions import features as fx
from raretide.functions import rowstats as rs
from raretide.spec import FIXTURE, PRESETS

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def hand(spark):
    rows = [
        (1, None, None, None, None),   # all null
        (2, 5.0, None, None, None),    # one value
        (3, 2.0, 2.0, 2.0, 2.0),       # constant
        (4, 1.0, 3.0, None, None),     # two values
        (5, 1.0, 2.0, 4.0, None),      # three values
        (6, 0.0, None, 1.0, 0.0),      # zeros vs null
        (7, 1.0, 2.0, 3.0, 10.0),      # four values
    ]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double")


def stats(df):
    return {r["id"]: r for r in df.select(
        "id", rs.nan_count(COLS).alias("nan"), rs.zero_count(COLS, True).alias("z2"),
        rs.zero_count(COLS, False).alias("z1"), rs.row_sum(COLS).alias("sum"), rs.row_mean(COLS).alias("mean"),
        rs.row_std(COLS).alias("std"), rs.row_max(COLS).alias("max"), rs.row_min(COLS).alias("min"),
        rs.row_median(COLS).alias("med"), rs.row_skew(COLS).alias("skew"), rs.row_kurt(COLS).alias("kurt"),
    ).collect()}


def test_row_stats_hand(hand):
    s = stats(hand)
    assert (s[1]["nan"], s[1]["sum"], s[1]["mean"], s[1]["max"], s[1]["med"]) == (4, 0.0, None, None, None)
    assert s[1]["z2"] == 4 and s[1]["z1"] == 0          # v2+ counts nulls as zero, v1 does not
    assert s[2]["mean"] == 5.0 and s[2]["std"] is None and s[2]["med"] == 5.0
    assert s[3]["std"] == 0.0 and s[3]["skew"] == 0.0 and s[3]["kurt"] == 0.0  # zero variance -> 0
    assert s[4]["std"] == pytest.approx(math.sqrt(2.0)) and s[4]["med"] == 2.0 and s[4]["skew"] is None
    assert s[5]["med"] == 2.0 and s[5]["kurt"] is None
    # skew of 1, 2, 4: n=3, mean 7/3, m2 = 14/3, m3 = 20/9 (central sums)
    g1 = 3 * math.sqrt(2) / 1 * (20 / 9) / (14 / 3) ** 1.5
    assert s[5]["skew"] == pytest.approx(g1)
    assert s[6]["z2"] == 3 and s[6]["z1"] == 2
    # 1, 2, 3, 10: mean 4, central sums m2 = 9+4+1+36 = 50, m4 = 81+16+1+1296 = 1394
    n = 4
    g2 = n * (n + 1) * (n - 1) * 1394 / ((n - 2) * (n - 3) * 50 ** 2) - 3 * (n - 1) ** 2 / ((n - 2) * (n - 3))
    assert s[7]["kurt"] == pytest.approx(g2)
    assert s[7]["med"] == 2.5 and s[7]["max"] == 10.0 and s[7]["min"] == 1.0


def test_ratio_and_log_nulls(spark):
    df = spark.createDataFrame([(1, 4.0, -1.0), (2, None, 1.0), (3, 2.0, None), (4, -3.0, 0.0)],
                               "id long, a double, b double")
    out = {r["id"]: r for r in df.select(
        "id", fx.ratio("a", "b").alias("r"), fx.ratio("a", "b", True).alias("rs"),
        fx.log_clip("a").alias("l"), fx.log_clip("a", True).alias("ls")).collect()}
    assert out[1]["r"] is None                       # divisor b + 1 = 0 -> NULL (imputed later)
    assert out[2]["r"] is None and out[2]["rs"] == 0.0
    assert out[3]["r"] is None and out[3]["rs"] == 2.0
    assert out[4]["l"] == 0.0 and out[2]["l"] is None and out[2]["ls"] == 0.0


def _wide(spark, n=5):
    import random
    rnd = random.Random(0)
    rows = []
    for i in range(n):
        vals = [None if rnd.random() < 0.2 else float(rnd.randint(0, 1)) for _ in range(50)]
        rows.append(tuple([i, i % 2] + vals))
    schema = "id long, target int, " + ", ".join(f"feature_{j} double" for j in range(1, 51))
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("version,width", [(1, 57), (2, 68), (3, 81), (4, 129)])
def test_preset_widths(spark, version, width):
    df = _wide(spark)
    spec = PRESETS[version]
    feats = [f"feature_{j}" for j in range(1, 51)]
    detected = feats if spec.auto_binary else None
    out = fx.engineer(df, spec, feats, detected)
    n = len([c for c in out.columns if c not in ("id", "target")])
    assert n == width
    # target encoding adds one column per encoded column: 93 (v3) and 143 (v4)
    assert n + len(spec.te_cols) == {1: 57, 2: 68, 3: 93, 4: 143}[version]


def test_engineer_is_one_narrow_plan(spark):
    from tests.conftest import SF001
    from raretide.sources.entities import train_test
    tr, _ = train_test(spark, SF001)
    out = fx.engineer(tr, FIXTURE)
    plan = out._jdf.queryExecution().executedPlan().toString()
    base = tr._jdf.queryExecution().executedPlan().toString()
    # The feature step adds no exchange to the entity view's own plan.
    assert plan.count("Exchange") == base.count("Exchange")
    assert out.count() == tr.count()
