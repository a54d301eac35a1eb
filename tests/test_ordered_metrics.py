"""Global order helpers, metrics, ranks and interpolation against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from raretide.operators import metrics, ordered, quantiles, ranknorm


def brute_ap(y, s):
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, tp, n = 0.0, 0, 0
    for t in order:
        pos = sum(1 for yi, si in zip(y, s) if si == t and yi == 1)
        cnt = sum(1 for si in s if si == t)
        tp += pos
        n += cnt
        ap += pos / P * tp / n
    return ap


def brute_auc(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    tot = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(7)
    rows = [(i, "m" + str(i % 2), int(rnd.random() < 0.2), float(rnd.randint(0, 30)) / 10) for i in range(400)]
    return rows, spark.createDataFrame(rows, "id long, model string, target int, score double")


@pytest.mark.parametrize("nb", [1, 4])
def test_ap_auc_vs_brute(scored, nb):
    rows, df = scored
    ap = {r["model"]: r["ap"] for r in metrics.average_precision(df, ["model"], n_buckets=nb).collect()}
    auc = {r["model"]: r["auc"] for r in metrics.roc_auc(df, ["model"], n_buckets=nb).collect()}
    for m in ("m0", "m1"):
        y = [r[2] for r in rows if r[1] == m]
        s = [r[3] for r in rows if r[1] == m]
        assert ap[m] == pytest.approx(brute_ap(y, s), abs=1e-12)
        assert auc[m] == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_metric_hand_cases(spark):
    perfect = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1), (0, 0.2)], "target int, score double")
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)], "target int, score double")
    assert metrics.average_precision(perfect, []).first()["ap"] == 1.0
    assert metrics.roc_auc(perfect, []).first()["auc"] == 1.0
    assert metrics.average_precision(tied, []).first()["ap"] == 0.5
    assert metrics.roc_auc(tied, []).first()["auc"] == 0.5


def test_ap_invariant_under_monotone_map(scored):
    _, df = scored
    a = metrics.average_precision(df, ["model"]).orderBy("model").collect()
    b = metrics.average_precision(df.withColumn("score", F.exp(F.col("score") * 3) + 1), ["model"]).orderBy("model").collect()
    assert [r["ap"] for r in a] == pytest.approx([r["ap"] for r in b])


@pytest.mark.parametrize("nb", [1, 3, 8])
def test_prefix_sums_bucketed_equals_simple(spark, nb):
    rnd = random.Random(1)
    rows = [(i % 3, float(i), rnd.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, x double, v long")
    got = {(r["k"], r["x"]): r["cum_v"] for r in ordered.prefix_sums(df, ["k"], ["x"], ["v"], n_buckets=nb).collect()}
    for k in range(3):
        run = 0
        for kk, x, v in sorted(r for r in rows if r[0] == k):
            run += v
            assert got[(k, x)] == run


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 40)) for _ in range(501)] + [None] * 20
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.05, 0.37, 0.5, 0.99, 1.0]
    got = sorted((r["q_idx"], r["quantile"]) for r in quantiles.exact_quantiles(df, [], "x", probs, n_buckets=4).collect())
    ref = np.percentile([v for v in vals if v is not None], [p * 100 for p in probs])
    assert [g for _, g in got] == pytest.approx(list(ref))


def test_rank_norm_and_interp(spark):
    knots_src = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.2), (4, 0.5)], "id long, score double")
    r = {row["id"]: row["rank_norm"] for row in ranknorm.average_rank(knots_src, []).collect()}
    assert r == {1: 1 / 5, 2: 2.5 / 5, 3: 2.5 / 5, 4: 4 / 5}
    o = {row["id"]: row["rank_norm"] for row in ranknorm.ordinal_rank(knots_src, []).collect()}
    assert o == {1: 1 / 5, 2: 2 / 5, 3: 3 / 5, 4: 4 / 5}
    knots = ranknorm.rank_knots(knots_src.withColumn("k", F.lit(0)), ["k"])
    probes = spark.createDataFrame([(10, 0.0), (11, 0.9), (12, 0.2), (13, 0.35)], "id long, score double") \
        .withColumn("k", F.lit(0))
    for nb in (1, 2):
        got = {row["id"]: row["rank_norm"] for row in ranknorm.interpolate(knots, probes, ["k"], n_buckets=nb).collect()}
        xs, ys = [0.1, 0.2, 0.5], [0.2, 0.5, 0.8]
        for pid, x in [(10, 0.0), (11, 0.9), (12, 0.2), (13, 0.35)]:
            assert got[pid] == pytest.approx(float(np.interp(x, xs, ys)))


@pytest.mark.parametrize("metric", ["ap", "auc"])
def test_search_equals_the_whole_grid(spark, metric):
    from raretide.operators import blend
    rnd = random.Random(11)
    rows = [(int(rnd.random() < 0.2), rnd.random(), rnd.random(), round(rnd.random(), 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "target int, a double, b double, c double")
    names, steps = ["a", "b", "c"], 10
    brute = brute_ap if metric == "ap" else brute_auc
    y = [r[0] for r in rows]
    want = {w: brute(y, [w[0] * a + w[1] * b + w[2] * c for _, a, b, c in rows]) for w in blend.grid_points(3, steps)}
    best = max(want, key=lambda w: (round(want[w], 12), [-x for x in w]))
    got = blend.search(df, names, steps, metric).first()
    assert (got.w1, got.w2, got.w3) == best and got.metric == pytest.approx(want[best], abs=1e-12)
    left = blend.surviving_points(df, names, steps, metric, first_bins=16)
    assert best in left
    ends = [(min(r[i] for r in rows), max(r[i] for r in rows)) for i in (1, 2, 3)]
    for bins in (4, 64):
        for w, (low, high) in zip(want, blend.metric_bounds(df, names, list(want), bins, ends, metric)):
            assert low - 1e-9 <= want[w] <= high + 1e-9


def test_search_keeps_a_winner_that_coarse_scores_hide(spark):
    """Many points tie in coarse bins; the true best differs only within one bin."""
    from raretide.operators import blend
    rows = [(0, 0.5 + i * 1e-6, 0.9 - i * 1e-3) for i in range(200)] + [(1, 0.5 + 201e-6 + i * 1e-6, 0.1 + i * 1e-3) for i in range(20)]
    rows += [(0, 0.0, 0.0), (0, 0.4, 1.0)]
    df = spark.createDataFrame(rows, "target int, a double, b double")
    got = blend.search(df, ["a", "b"], 100, "ap").first()
    assert (got.w1, got.w2) == (100, 0) and got.metric == 1.0


def test_bucket_of_counts_the_bounds_below(spark):
    bounds = [float(i * i) for i in range(37)]
    df = spark.range(0, 1500).select((F.col("id") - 20).cast("double").alias("x"), F.array(*map(F.lit, bounds)).alias("b"))
    for r in df.select("x", ordered.bucket_of(F.col("x"), F.col("b")).alias("n")).collect():
        assert r.n == sum(v < r.x for v in bounds)


def test_ordinal_rank_splits_a_hot_score(spark):
    rows = [(i * 7 % 1009, 0.5 if i % 10 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, score double")
    order = {r: k + 1 for k, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    for nb in (2, 8):
        got = {(r.id, r.score): r.rank_norm for r in ranknorm.ordinal_rank(df, [], n_buckets=nb).collect()}
        assert got == {r: k / 1001 for r, k in order.items()}


@pytest.mark.parametrize("metric", ["ap", "auc"])
def test_grid_counts_in_chunks_and_tiles(spark, metric):
    """Every point equals brute force over rows with ties, nulls and NaN, however rows and positives are dealt."""
    from raretide.operators import blend
    rnd = random.Random(5)
    rows = [(int(rnd.random() < 0.2), rnd.choice([None, float("nan"), -0.0, 0.0, rnd.gauss(0, 1), 0.5]), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "target int, a double, b double")
    brute = brute_ap if metric == "ap" else brute_auc
    y = [r[0] for r in rows]

    def key(w, a, b):
        return -1e300 if a is None else 1e300 if a != a else w * a + (4 - w) * b
    want = {w: brute(y, [key(w, a, b) for _, a, b in rows]) for w in range(5)}
    for chunk, tile in ((1000, 1000), (70, 1000), (70, 11)):
        got = {r.w1: r.metric for r in blend.grid_metric(df, ["a", "b"], 4, metric, chunk_rows=chunk, tile_rows=tile).collect()}
        assert got == {w: pytest.approx(v, abs=1e-12) for w, v in want.items()}
    assert {r.metric for r in blend.grid_metric(df.where("target = 0"), ["a", "b"], 4, metric).collect()} == {None}
    assert blend.grid_metric(df.where("false"), ["a", "b"], 4, metric).collect() == []


def test_whole_grid_of_many_points_ends(spark):
    """5,151 points x 50,000 rows: a row per row and point (258 million) would not end within the time."""
    import time

    from raretide.operators import blend
    n, names = 50_000, ["a", "b", "c"]
    df = spark.range(n, numPartitions=4).select("id", (F.xxhash64("id") % 25 == 0).cast("int").alias("target"),
                                                *[((F.xxhash64("id", F.lit(i)) / 2.0**64) + 0.5).alias(m) for i, m in enumerate(names)])
    begun = time.time()
    got = {(r.w1, r.w2): r.metric for r in blend.grid_metric(df, names, 100, "ap").collect()}
    assert len(got) == 5151 and time.time() - begun < 60
    rows = df.collect()
    for w1, w2 in ((0, 0), (37, 21)):
        order = sorted(rows, key=lambda r: -(w1 * r.a + w2 * r.b + (100 - w1 - w2) * r.c))  # scores are distinct
        hits, total = 0, 0.0
        for i, r in enumerate(order, 1):
            hits += r.target
            total += r.target * hits / i
        assert got[w1, w2] == pytest.approx(total / hits, abs=1e-12)


def test_grid_counts_leave_point_by_point(spark, capfd):
    """The tasks of the grid hand over a point's counts as they are made, and one tile of all positives says the same as many."""
    from raretide.operators import blend
    rnd = random.Random(11)
    rows = [(int(rnd.random() < 0.2), rnd.choice([0.0, 0.5, 1.0, None]), rnd.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "target int, a double, b double")
    for metric in ("ap", "auc"):
        one, many = (blend.grid_metric(df, ["a", "b"], 6, metric, chunk_rows=chunk, tile_rows=tile) for chunk, tile in ((1000, 1000), (70, 9)))
        got = [{(r.w1, r.w2): r.metric for r in g.collect()} for g in (one, many)]
        assert len(got[0]) == 7 and got[0] == pytest.approx(got[1], abs=1e-12)
    capfd.readouterr()
    one.explain()
    plan = capfd.readouterr().out
    assert "FlatMapGroupsInArrow" in plan and "FlatMapCoGroupsInPandas" not in plan


def test_order_keys_take_the_place_of_the_scores():
    from raretide.operators import blend
    scores = np.array([0.5, -0.0, float("nan"), -2.0, 0.0, -1.0, float("inf"), 3.0])
    missing = np.array([False] * 7 + [True])
    keys = blend._order_keys(scores, missing)
    assert np.shares_memory(keys, scores)
    assert list(np.argsort(keys, kind="stable")) == [7, 3, 5, 1, 4, 0, 6, 2] and keys[1] == keys[4]
