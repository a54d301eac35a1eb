"""SMOTE exactness and properties, learners, stages, the entry smoke test."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001


def test_knn_exact_vs_brute_force(spark):
    from raretide.operators import resample
    rnd = random.Random(5)
    rows = [(i, i % 3, [rnd.gauss(0, 1) * (10 if j == 0 else 1) for j in range(4)]) for i in range(150)]
    g = spark.createDataFrame(rows, "id long, fold int, vec array<double>").withColumn("target", F.lit(1))
    groups = resample.minority_groups(g, 3)
    for window, nb in ((2, 4), (16, 1)):          # small frame + buckets forces the band-join path
        got = {(r.tf, r.id, r.rank): r.nn_id for r in resample.knn(groups, 5, window=window, n_buckets=nb).collect()}
        for tf in range(3):
            pts = [(i, np.array(v)) for i, f, v in rows if f != tf]
            for i, v in pts:
                d = sorted(((float(np.sum((v - w) ** 2)), j) for j, w in pts if j != i))
                for rank, (_, j) in enumerate(d[:5], start=1):
                    assert got[(tf, i, rank)] == j


def test_knn_ties_and_one_dimension(spark):
    """Integer coordinates (exact distances, many ties broken by id) and a 1-D case."""
    from raretide.operators import resample
    rnd = random.Random(8)
    for dims in (1, 3):
        rows = [(i, i % 2, [float(rnd.randint(0, 4)) for _ in range(dims)]) for i in range(80)]
        g = spark.createDataFrame(rows, "id long, fold int, vec array<double>").withColumn("target", F.lit(1))
        groups = resample.minority_groups(g, 2)
        got = {(r.tf, r.id, r.rank): r.nn_id for r in resample.knn(groups, 5, window=2, n_buckets=3).collect()}
        for tf in range(2):
            pts = [(i, v) for i, f, v in rows if f != tf]
            for i, v in pts:
                d = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in pts if j != i)
                for rank, (_, j) in enumerate(d[:5], start=1):
                    assert got[(tf, i, rank)] == j


def test_smote_rows_on_segments_and_counts(spark):
    from raretide.operators import folds, resample
    rnd = random.Random(9)
    rows = [(i, int(i % 10 == 0), rnd.random(), rnd.random() * 5) for i in range(1, 601)]
    df = spark.createDataFrame(rows, "id long, target int, x double, y double")
    f = folds.stratified_folds(df, 4, 42, keep_rank=True)
    syn, nn = resample.oversample(f, ["x", "y"], 4, ratio=0.25, k=3)
    cnt = {r.tf: r.n_syn for r in resample.synthetic_counts(f, 4, 0.25).collect()}
    made = {r.tf: r["count"] for r in syn.groupBy("tf").count().collect()}
    assert made == {k: v for k, v in cnt.items() if v > 0}
    pts = {r[0]: (r[2], r[3]) for r in rows}
    fold_of = {r.id: r.fold for r in f.collect()}
    for r in syn.collect():
        a, b = np.array(pts[r.base_id]), np.array(pts[r.nn_id])
        assert fold_of[r.base_id] != r.tf and fold_of[r.nn_id] != r.tf    # validation rows untouched
        assert np.allclose(np.array([r.x, r.y]), a + r.u * (b - a))
        assert 0.0 <= r.u < 1.0


def test_stage_resume(spark):
    import uuid
    from raretide.sources import stages
    calls = []
    fp = uuid.uuid4().hex

    def build():
        calls.append(1)
        return spark.range(10)
    assert stages.stage(spark, "t", fp, build).count() == 10
    assert stages.stage(spark, "t", fp, build).count() == 10
    assert len(calls) == 1
    stages.stage(spark, "t", fp + "2", build)
    assert len(calls) == 2


def test_cross_val_quality_floor(spark):
    from raretide.operators import learners, metrics
    from raretide.plans import pipeline
    cfg = pipeline.PlanConfig(members=[])
    tr, ts, feats, spw, key = pipeline.features_stage(spark, SF001, cfg)
    cv = learners.cross_val(tr, ts, feats, learners.member("lgb", 5), 5, spw)
    oof = cv.oof.collect()
    assert len(oof) == tr.count() and len({r.id for r in oof}) == len(oof)   # one OOF score per row
    ap = metrics.average_precision(cv.oof, []).first()["ap"]
    pos_rate = sum(r.target for r in oof) / len(oof)
    assert ap > pos_rate
    assert cv.test.count() == ts.count()


def test_isotonic_monotone(spark):
    from raretide.operators import calibrate
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.random(), int(rnd.random() < 0.3)) for _ in range(300)], "score double, target int")
    m = calibrate.fit_isotonic(df)
    probe = spark.createDataFrame([(x / 20 - 0.5,) for x in range(40)], "score double")
    out = [r.calibrated for r in calibrate.apply_isotonic(m, probe).orderBy("score").collect()]
    assert all(a <= b + 1e-12 for a, b in zip(out, out[1:]))


def test_blend_not_worse_than_members(spark):
    from tests.conftest import SF01
    from raretide.operators import blend, metrics
    from raretide.plans import fixture
    w = fixture.oof_wide(spark, SF01)
    best = blend.search(w, ["m1", "m2", "m3"], 20, "ap").first()
    for m in ("m1", "m2", "m3"):
        ap = metrics.average_precision(w.select("target", F.col(m).alias("score")), []).first()["ap"]
        assert best["metric"] >= ap - 1e-12


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
