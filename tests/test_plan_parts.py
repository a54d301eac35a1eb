"""Prefix early stopping, the rung search, nested encoding, stumps, commit records, pseudo rows before SMOTE, tails."""

import json
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from raretide.operators import encode, folds, impute, learners, resample, stump
from raretide.plans import pipeline
from raretide.sources import stages


def some(spark, n=240, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        x, y = rnd.random(), rnd.random()
        rows.append((i, int(rnd.random() < 0.1 + 0.6 * (x > 0.7) * (y > 0.4)), x, y, rnd.choice([None, 1.0, 2.0])))
    df = spark.createDataFrame(rows, "id long, target int, x double, y double, z double")
    return rows, folds.stratified_folds(df, 3, 42, keep_rank=True)


def test_prefix_equals_a_fit_that_stops_there(spark):
    _, f = some(spark)
    rows = learners.assembler(["x", "y"]).transform(learners.with_weight(f, 3.0)).repartition(2).cache()
    m = learners.member("xgb", 6, maxDepth=3, minInstancesPerNode=1)
    whole = m.estimator().fit(rows)
    short = learners.Member(m.name, m.params, 2).estimator().fit(rows)
    cut = learners.prefix_model(whole, 2)
    a, b = ([r.score for r in learners.positive_score(model.transform(rows)).orderBy("id").collect()] for model in (cut, short))
    assert a == pytest.approx(b, abs=1e-12) and cut.getNumTrees == 2
    assert whole.getNumTrees == 6


def test_early_stop_keeps_the_best_prefix(spark):
    _, f = some(spark)
    m = learners.member("xgb", 5, maxDepth=4, minInstancesPerNode=1, stepSize=0.9)
    cv = learners.cross_val(f, f, ["x", "y"], m, 3, 3.0, early_stop=True)
    assert set(cv.best_iters) == {0, 1, 2} and min(cv.best_iters.values()) < 5
    assert cv.oof.count() == 240 and cv.test.count() == 240


def test_rungs_continue_the_best_trials(spark):
    _, f = some(spark)
    f = f.where("fold < 2")
    table, winner = learners.rung_search(f, ["x", "y"], learners.member("xgb", 4, maxDepth=2), 2, 3.0, 3, keep=2)
    rows = table.collect()
    by = {r: [x for x in rows if x.rung == r] for r in {x.rung for x in rows}}
    assert [len(by[r]) for r in sorted(by)] == [3, 2] and {x.trees for x in by[1]} == {4} and {x.trees for x in by[0]} == {2}
    best = sorted(by[0], key=lambda x: (-x.mean_ap, x.trial))[:2]
    assert {x.trial for x in by[1]} == {x.trial for x in best}
    final = sorted(by[1], key=lambda x: (-x.mean_ap, x.trial))[0]
    assert {k: str(v) for k, v in winner.items()} == final.params


def test_nested_encoding_ignores_the_held_out_labels(spark):
    _, f = some(spark)
    flip = f.withColumn("target", F.when(F.col("fold") == 1, 1 - F.col("target")).otherwise(F.col("target")))
    out = []
    for df in (f, flip):
        m = encode.NestedTargetEncoder(["x", "z"], 3, smooth=5, n_bins=4).fit(df)
        out.append([{r.id: (r.te_x, r.te_z) for r in m.transform_train(df, o).collect()} for o in range(3)])
    assert out[0][1] == out[1][1] and out[0][0] != out[1][0]
    both = encode.NestedTargetEncoder(["x"], 3).fit(f)
    assert {"te_x__o0", "te_x__o1", "te_x__o2"} <= set(both.transform_all(f, True).columns)


def best_stump(rows, cols, spw):
    def pure(p, n):
        return ((spw * p) ** 2 + n * n) / (spw * p + n)
    best = None
    for i in range(len(cols)):
        for t in sorted({r[2 + i] for r in rows if r[2 + i] is not None}):
            left = [r[1] for r in rows if r[2 + i] is not None and r[2 + i] <= t]
            if len(left) == len(rows):
                continue
            p, n = sum(left), len(left) - sum(left)
            q, m = sum(r[1] for r in rows) - p, sum(1 - r[1] for r in rows) - n
            gain = pure(p, n) + pure(q, m)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, cols[i], t, spw * p / (spw * p + n), spw * q / (spw * q + m))
    return best


def test_stumps_equal_brute_force(spark):
    rows, f = some(spark, 150)
    fold = {r.id: r.fold for r in f.collect()}
    got = stump.fit_stumps(f, ["x", "y", "z"], 3, 2.5)
    for tf in range(3):
        want = best_stump([r for r in rows if fold[r[0]] != tf], ["x", "y", "z"], 2.5)
        s = got[tf]
        assert (s.col, s.threshold) == want[1:3] and (s.left, s.right) == pytest.approx(want[3:])
    flat = f.select("id", "fold", "target", F.lit(1.0).alias("x"))
    assert all(s.col is None for s in stump.fit_stumps(flat, ["x"], 3, 2.5).values())


def test_commit_record_holds_metrics(spark, tmp_path):
    fp, root, calls = uuid.uuid4().hex, str(tmp_path), []

    def metrics(table):
        calls.append(1)
        return [("m", None, "n", float(table.count())), ("m", 2, "ap", 0.5)]
    assert stages.stage_metrics(spark, "s", fp, root) is None
    for _ in range(2):
        stages.stage(spark, "s", fp, lambda: spark.range(7), root, metrics=metrics)
    assert calls == [1] and stages.stage_metrics(spark, "s", fp, root) == [("m", None, "n", 7.0), ("m", 2, "ap", 0.5)]
    record = json.loads((tmp_path / f"stages/s/fp={fp}" / stages.COMMIT).read_text())
    assert record["key"] == fp and record["table"].endswith(fp)
    (tmp_path / f"stages/s/fp={fp}" / stages.COMMIT).rename(tmp_path / "lost")
    stages.stage(spark, "s", fp, lambda: spark.range(8), root, metrics=metrics)  # without its record a stage is built again
    assert stages.stage_metrics(spark, "s", fp, root)[0][3] == 8.0


def test_pseudo_rows_stand_in_every_split_before_smote(spark):
    rows, f = some(spark)
    extra = spark.createDataFrame([(10_000 + i, i % 2, 0.9 + i / 1000, 0.5) for i in range(12)], "id long, target int, x double, y double")
    _, table = resample.oversample(f, ["x", "y"], 3, ratio=0.8, k=3)
    syn, updated = resample.oversample(f, ["x", "y"], 3, ratio=0.8, k=3, neighbours=table, extra=extra)
    again, full = resample.oversample(f, ["x", "y"], 3, ratio=0.8, k=3, extra=extra)
    key = lambda df: sorted((r.tf, r.syn_id, r.base_id, r.nn_id, r.u) for r in df.collect())
    assert key(syn) == key(again)
    near = lambda df: sorted((r.tf, r.id, r["rank"], r.nn_id) for r in df.collect())
    assert near(updated) == near(full)
    made = {r.tf: r["count"] for r in syn.groupBy("tf").count().collect()}
    fold = {r.id: (r.fold, r.target) for r in f.collect()}
    for tf in range(3):
        n_pos = sum(t for g, t in fold.values() if g != tf) + 6
        n_neg = sum(1 - t for g, t in fold.values() if g != tf) + 6
        assert made[tf] == int(np.floor(n_neg * 0.8)) - n_pos
    assert any(r.base_id >= 10_000 for r in syn.collect())


def test_plan_with_nested_encoding_search_and_pseudo_rows(spark):
    from tests.conftest import SF001
    small = [learners.member("xgb", 2, maxDepth=3), learners.member("rf", 2, maxDepth=3)]
    cfg = pipeline.PlanConfig(k_folds=2, members=small, leak_safe=True, search_trials=1, search_folds=2, use_pseudo=True, tail="ordinal", blend_steps=5)
    done = pipeline.run(spark, SF001, cfg)
    tests = done.final.count()
    assert tests == done.test.select("id").distinct().count() and done.method in ("rank_norm", "blend")
    names, nested = pipeline.model_features(done.features, cfg)
    assert nested and set(nested) <= set(names) and not any("__o" in c for c in names)
    with pytest.raises(ValueError):
        pipeline.finish(done.oof, done.test, ["xgb"], "unknown")


def test_stump_ranges_follow_the_rows(spark, monkeypatch):
    """A column of many distinct values is ordered in ranges of counted size, with the same splits."""
    rows, f = some(spark, 150)
    asked, real = [], stump.prefix_sums
    monkeypatch.setattr(stump, "prefix_sums", lambda *a, **k: asked.append(k["n_buckets"]) or real(*a, **k))
    cols = ["x", "y", "z"]
    whole, cut = ({tuple(r) for r in stump.split_candidates(f, cols, 3, 2.5, rows_per_bucket=n).collect()} for n in (1000, 10))
    assert asked[1] >= 15 and whole == cut


def test_nested_edges_come_from_one_set_of_passes(spark, monkeypatch):
    rows, f = some(spark, 120)
    calls, real = [], encode.column_quantiles
    monkeypatch.setattr(encode, "column_quantiles", lambda df, cols, *a, **k: calls.append(cols) or real(df, cols, *a, **k))
    m = encode.NestedTargetEncoder(["x", "z"], 3, smooth=5, n_bins=4).fit(f)
    assert len(calls) == 1
    for o in range(3):
        want = {r["col"]: [] for r in real(f, ["x", "z"], [0.5]).collect()}
        for r in real(f.where(F.col("fold") != o), ["x", "z"], [i / 4 for i in range(5)]).orderBy("q_idx").collect():
            want[r["col"]].append(r["quantile"])
        assert m.models[o].inner == {c: encode.inner_edges(e) for c, e in want.items()}


def test_medians_are_taken_of_columns_with_nulls_alone(spark, monkeypatch):
    _, f = some(spark)
    probes = spark.range(1000, 1040).select("id", F.when(F.col("id") > 1005, 0.5).alias("x"), F.lit(0.25).alias("y"), F.lit(1.0).alias("z"))
    asked = []

    class Noted(impute.MedianImputer):
        def __init__(self, cols, exact=True):
            asked.append(list(cols))
            super().__init__(cols, exact)

    monkeypatch.setattr(pipeline, "MedianImputer", Noted)
    cfg = pipeline.PlanConfig(k_folds=3)
    tr, ts, feats = pipeline.encoded(f, probes, cfg)
    assert asked == [["x", "z"]] and feats == ["x", "y", "z"]  # x has nulls on the test side, z on the train side
    med = {c: float(np.median([r[c] for r in f.collect() if r[c] is not None])) for c in feats}
    for before, after in ((f, tr), (probes, ts)):
        old = {r.id: r for r in before.collect()}
        for r in after.collect():
            assert all(r[c] == pytest.approx(med[c] if old[r.id][c] is None else old[r.id][c]) for c in feats)
    whole = f.where("z is not null")
    assert [r.id for r in pipeline.encoded(whole, probes.where("x is not null"), cfg)[0].collect()] == [r.id for r in whole.collect()] and len(asked) == 1


def test_stages_are_written_with_methods_that_the_jvm_compiles(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(name), []

    def build():
        seen.append(spark.conf.get(name))
        return spark.range(3)

    def fails():
        raise ValueError("no table")

    assert stages.stage(spark, "methods", uuid.uuid4().hex, build).count() == 3
    with pytest.raises(ValueError):
        stages.stage(spark, "methods", uuid.uuid4().hex, fails)
    assert seen == ["8000"] and spark.conf.get(name) == before


def test_fits_join_their_partitions(spark, monkeypatch):
    rows, f = some(spark)
    names = ["id", "target", "fold", "x", "y"]
    dealt = spark.createDataFrame(spark.sparkContext.parallelize([tuple(r[n] for n in names) for r in f.collect()], 60), "id long, target int, fold int, x double, y double")
    seen, fit = [], learners.GBTClassifier.fit
    monkeypatch.setattr(learners.GBTClassifier, "fit", lambda self, df, *a: (seen.append(df.rdd.getNumPartitions()), fit(self, df, *a))[1])
    m = learners.member("xgb", 2, maxDepth=2, minInstancesPerNode=1)
    assert learners.cross_val(dealt, None, ["x", "y"], m, 2, 3.0).oof.where("fold < 2").count() > 0
    cores = spark.sparkContext.defaultParallelism
    assert cores < 60 and seen == [cores, cores]
    monkeypatch.setattr(learners, "FIT_ROWS", 5)  # 240 rows: 48 partitions
    learners.cross_val(dealt, None, ["x", "y"], m, 1, 3.0)
    assert seen[2:] == [max(48, cores)]


def test_named_extra_rows_keep_their_synthetic_rows(spark, monkeypatch):
    _, f = some(spark)
    extra = spark.createDataFrame([(10_000 + i, i % 2, 0.9 + i / 1000, 0.5) for i in range(12)], "id long, target int, x double, y double")
    calls, made = [], resample.oversample
    monkeypatch.setattr(pipeline.resample, "oversample", lambda *a, **k: (calls.append(1), made(*a, **k))[1])
    cfg, key = pipeline.PlanConfig(k_folds=3, smote_ratio=0.8, k_nn=3, members=[]), uuid.uuid4().hex
    args = (spark, f, ["x", "y"], cfg, key, extra)
    plain = pipeline.smote_stage(*args)
    first, again = pipeline.smote_stage(*args, "chosen"), pipeline.smote_stage(*args, "chosen")
    drawn = lambda df: sorted((r.tf, r.syn_id, r.base_id, r.nn_id, r.u, r.x, r.y) for r in df.collect())
    assert len(calls) == 2 and all("smote_extra" in x for x in first.inputFiles())
    assert drawn(first) == drawn(again) == drawn(plain)


def test_registered_search_runs_all_published_trials(spark, monkeypatch):
    """80 trials in four rungs; no trial is left out of the first."""
    from raretide.plans import catalog
    from raretide.sources import stages
    asked, fitted = [], []

    def cross_val(train, test, features, m, *rest, **more):
        fitted.append((m.name, m.max_iter))
        return learners.CVResult(train.limit(0).select("id", F.lit(0).alias("fold"), F.lit(1).alias("target"), F.lit(0.5).alias("score")), None, None)

    def search_stage(spark, tr, feats, m, cfg, spw, key):
        asked.append(cfg.search_trials)

    monkeypatch.setattr(catalog, "_plan", lambda spark, sf: (pipeline, pipeline.PlanConfig(members=[]), None, None, [], 1.0, "k"))
    monkeypatch.setattr(pipeline, "search_stage", search_stage)
    monkeypatch.setattr(stages, "stage", lambda *a, **k: None)
    catalog.q_random_search(spark, "")
    assert asked == [80]
    f = spark.createDataFrame([(1, 0, 0, 0.0)], "id long, target int, fold int, x double")
    monkeypatch.setattr(learners, "cross_val", cross_val)
    table, _ = learners.rung_search(f, ["x"], learners.member("lgb", 20), 2, 1.0, asked[0])
    by = {r.rung: r.n for r in table.groupBy("rung").agg(F.countDistinct("trial").alias("n")).collect()}
    assert by == {0: 80, 1: 27, 2: 9, 3: 3} and len(fitted) == 119


def test_fits_run_side_by_side_as_far_as_memory_goes(spark, monkeypatch):
    import threading
    _, f = some(spark)
    assert learners.fits_at_once(spark, 1000, 60) > 5 and learners.fits_at_once(spark, 10**12, 60) == 1
    now, most, lock, fit = [0], [], threading.Lock(), learners.GBTClassifier.fit

    def watched(self, df, *a):
        with lock:
            now[0] += 1
            most.append(now[0])
        try:
            return fit(self, df, *a)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(learners.GBTClassifier, "fit", watched)
    m = learners.member("xgb", 2, maxDepth=2, minInstancesPerNode=1)
    scores = lambda: {r.id: r.score for r in learners.cross_val(f, None, ["x", "y"], m, 3, 3.0).oof.collect()}
    side = scores()
    assert max(most) > 1
    most.clear()
    monkeypatch.setattr(learners, "FIT_ROW_BYTES", 10**12)  # room for one fit
    assert scores() == side and most == [1, 1, 1]
