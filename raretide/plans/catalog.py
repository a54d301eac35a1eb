"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the fixture entity view) and
runs over all of their rows.  Computed doubles are rounded to 6 decimals so
the SQL oracle can compare values; keys and counts are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raretide.functions import features as fx
from raretide.operators import blend, encode, folds, impute, metrics, profile, ranknorm
from raretide.plans.fixture import (FEATURES, K_FOLDS, MODELS, folded_train, oof_long, oof_wide, r6, split, test_long,
                                    test_wide)
from raretide.sources.entities import entity_features
from raretide.spec import FIXTURE, FIXTURE_PRESETS, FeatureSpec

Query = Callable[[SparkSession, str], DataFrame]
TE_COLS = list(FIXTURE.te_cols)
#: Trials of the registered parameter search, as many as the published one has.
SEARCH_TRIALS = 80


def _round_doubles(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[r6(c).alias(c) if (t == "double" and c not in keep) else F.col(c) for c, t in df.dtypes])


# ---------------------------------------------------------------- sources / profiling
def q_scan_entities(spark, sf):
    return entity_features(spark, sf)


def q_profile_target(spark, sf):
    train, _ = split(spark, sf)
    return _round_doubles(profile.target_profile(train))


def q_profile_missing(spark, sf):
    train, _ = split(spark, sf)
    return _round_doubles(profile.missing_profile(train, FEATURES))


def q_binary_columns(spark, sf):
    train, _ = split(spark, sf)
    return profile.binary_profile(train, FEATURES)


def q_smote_preview(spark, sf):
    train, _ = split(spark, sf)
    return profile.smote_preview(train, ratio=0.10, val_share=0.2)


def q_score_summary(spark, sf):
    return _round_doubles(profile.score_summary(test_long(spark, sf), "score", ["model"]))


def q_score_head(spark, sf):
    t = test_wide(spark, sf)
    return t.select("id", r6("m1").alias("target")).orderBy("id").limit(10)


def q_nulls_after_impute(spark, sf):
    train, _ = split(spark, sf)
    model = impute.MedianImputer(FEATURES).fit(train)
    before = profile.nulls_remaining(train, FEATURES).select(F.col("n_null").alias("n_null_before"))
    after = profile.nulls_remaining(model.transform(train), FEATURES)
    return profile._one_row_join(after, before)


def q_metric_report(spark, sf):
    per = metrics.average_precision(oof_long(spark, sf), ["model", "fold"], alias="value")
    return _round_doubles(profile.metric_report(per, ["model"]))


# ---------------------------------------------------------------- row features
def _eng(spark, sf, spec: FeatureSpec = FIXTURE) -> DataFrame:
    train, _ = split(spark, sf)
    return fx.engineer(train, spec, FEATURES)


def _pick(df: DataFrame, cols: list[str]) -> DataFrame:
    return _round_doubles(df.select("id", *[F.col(c).cast("int").alias(c) if dict(df.dtypes)[c] == "tinyint"
                                            else F.col(c) for c in cols]))


def q_feat_missing_flags(spark, sf):
    e = _eng(spark, sf)
    return _pick(e, [f"{c}_miss" for c in FIXTURE.miss_cols] + ["fe_miss_pattern_sum"])


def q_feat_row_counts(spark, sf):
    train, _ = split(spark, sf)
    from raretide.functions import rowstats as rs
    return _round_doubles(train.select(
        "id", rs.nan_count(FEATURES).cast("double").alias("fe_nan_count"),
        rs.zero_count(FEATURES, null_is_zero=True).cast("double").alias("fe_zero_count"),
        rs.zero_count(FEATURES, null_is_zero=False).cast("double").alias("fe_zero_count_v1")))


def q_feat_row_stats(spark, sf):
    return _pick(_eng(spark, sf), ["fe_row_sum", "fe_row_mean", "fe_row_std", "fe_row_max", "fe_row_min"])


def q_feat_row_shape(spark, sf):
    return _pick(_eng(spark, sf), ["fe_row_median", "fe_row_skew", "fe_row_kurt"])


def q_feat_binary_agg(spark, sf):
    train, _ = split(spark, sf)
    detected = profile.detect_binary(train, FEATURES)
    declared = fx.binary_columns(list(FIXTURE.binary_cols), FIXTURE)
    from raretide.functions import rowstats as rs
    return _round_doubles(train.select(
        "id", *declared, rs.row_sum(detected).alias("fe_binary_sum_auto")))


def q_feat_pairwise(spark, sf):
    e = _eng(spark, sf)
    b = list(FIXTURE.binary_cols)
    return _pick(e, [f"fe_{c1}_{c2}" for i, c1 in enumerate(b[:8]) for c2 in b[i + 1:9]])


def q_feat_ratios(spark, sf):
    e = _eng(spark, sf)
    return _pick(e, [c for c in e.columns if c.startswith("fe_ratio_")])


def q_feat_poly_log(spark, sf):
    e = _eng(spark, sf)
    return _pick(e, ["fe_4_x_3", "fe_1_sq", "fe_2_log", "fe_5_log"])


def q_feat_interactions(spark, sf):
    e = _eng(spark, sf)
    return _pick(e, ["fe_12_x_1", "fe_12_x_7", "fe_12_x_8", "fe_12_x_9", "fe_12_div_9", "fe_12_sq"])


def q_engineer_v4(spark, sf):
    e = _eng(spark, sf)
    return _pick(e, [c for c in e.columns if c != "id"])


# ---------------------------------------------------------------- target encoding
def _te_model(spark, sf):
    f = folded_train(spark, sf)
    _, test = split(spark, sf)
    return f, test, encode.TargetEncoder(TE_COLS, smooth=30, n_bins=20).fit(f, test)


def q_te_edges(spark, sf):
    train, test = split(spark, sf)
    return _round_doubles(encode.quantile_edges(train, test, TE_COLS, 20)).select(
        "col", F.col("q_idx").cast("int").alias("q_idx"), "edge")


def q_te_bins(spark, sf):
    f, test, m = _te_model(spark, sf)
    b = m.bins(f.select("id", *TE_COLS))
    long = b.select("id", *[F.struct(F.col(c).alias("x"), F.col(f"bin_{c}").alias("b")).alias(c) for c in TE_COLS]) \
        .unpivot(["id"], TE_COLS, "col", "v")
    return long.filter(F.col("v.x").isNotNull()).select("id", "col", F.col("v.b").cast("int").alias("bin"))


def q_te_fold_stats(spark, sf):
    f, test, m = _te_model(spark, sf)
    st = encode.fold_stats(m.bins(f), TE_COLS, m.prior, 30.0)
    return _round_doubles(st.select("col", F.col("fold").cast("int").alias("fold"), "bin",
                                    F.col("n_other").cast("long").alias("n_other"),
                                    F.col("s_other").cast("long").alias("s_other"), "enc"))


def q_te_oof(spark, sf):
    f, test, m = _te_model(spark, sf)
    out = m.transform_oof(f).select("id", *[f"te_{c}" for c in TE_COLS])
    return _round_doubles(out.unpivot(["id"], [f"te_{c}" for c in TE_COLS], "col", "te"))


def q_te_test(spark, sf):
    f, test, m = _te_model(spark, sf)
    out = m.transform_test(test).select("id", *[f"te_{c}" for c in TE_COLS])
    return _round_doubles(out.unpivot(["id"], [f"te_{c}" for c in TE_COLS], "col", "te"))


# ---------------------------------------------------------------- imputation / folds
def q_impute_median(spark, sf):
    train, _ = split(spark, sf)
    return _round_doubles(impute.MedianImputer(FEATURES).medians_frame(train))


def q_standardise_scores(spark, sf):
    oof = oof_wide(spark, sf)
    st = impute.fit_standardiser(oof, ["m1", "m2"])
    t = st.transform(test_wide(spark, sf).select("id", "m1", "m2"))
    return _round_doubles(t.select("id", F.col("m1").alias("z_m1"), F.col("m2").alias("z_m2")))


def q_stratified_folds(spark, sf):
    return folded_train(spark, sf).select("id", "target", "fold")


def q_fold_sizes(spark, sf):
    return folds.fold_sizes(folded_train(spark, sf))


def q_class_weights(spark, sf):
    train, _ = split(spark, sf)
    from raretide.operators import learners
    spw = profile.target_profile(train).first()["scale_pos_weight"]  # one number
    return _round_doubles(learners.with_weight(train.select("id", "target"), spw).select("id", "target", "weight"))


# ---------------------------------------------------------------- metrics
def q_roc_auc(spark, sf):
    return _round_doubles(metrics.roc_auc(oof_long(spark, sf), ["model"]))


def q_average_precision(spark, sf):
    return _round_doubles(metrics.average_precision(oof_long(spark, sf), ["model"]))


def q_metric_by_fold(spark, sf):
    return _round_doubles(metrics.metric_by_fold(oof_long(spark, sf), ["model"]))


# ---------------------------------------------------------------- blending
def _grid(spark, sf, models, steps, metric):
    g = blend.grid_metric(oof_wide(spark, sf), models, steps, metric)
    names = blend.weight_names(len(models))
    # The grid result is tiny (one row per weight point): rank it in one window.
    w = Window.orderBy(F.round("metric", 12).desc(), *names)
    return g.select(*names, r6("metric").alias("metric"), (F.row_number().over(w) == 1).alias("is_best"))


def q_blend2_auc(spark, sf):
    return _grid(spark, sf, ["m1", "m2"], 100, "auc")


def q_blend3_ap(spark, sf):
    return _grid(spark, sf, ["m1", "m2", "m3"], 20, "ap")


def q_blend4_ap(spark, sf):
    return _grid(spark, sf, MODELS, 20, "ap")


def _searched(spark, sf, models):
    best = blend.search(oof_wide(spark, sf), models, 20, "ap")
    return best.select(*blend.weight_names(len(models)), r6("metric").alias("metric"))


def q_blend_search3(spark, sf):
    return _searched(spark, sf, ["m1", "m2", "m3"])


def q_blend_search4(spark, sf):
    return _searched(spark, sf, MODELS)


def q_scan_csv(spark, sf):
    """The fixture entities through a CSV whose columns stand in another order."""
    import uuid
    from raretide.session import checkpoint_root
    from raretide.sources import entities
    path = f"{checkpoint_root(spark)}/scan-{uuid.uuid4().hex}"
    ent = entity_features(spark, sf)
    ent.select(*reversed(ent.columns)).write.option("header", True).option("nullValue", "NA").csv(path)
    return entities.scan_csv(spark, path, entities.entity_schema(len(FEATURES)))


def q_blend_apply(spark, sf):
    models = ["m1", "m2", "m3"]
    best = blend.search(oof_wide(spark, sf), models, 20, "ap").first()  # one row
    w = [best[n] / 20.0 for n in blend.weight_names(3)]
    oof = blend.apply_weights(oof_wide(spark, sf), models, w).select("id", F.lit("oof").alias("split"), "blend")
    tst = blend.apply_weights(test_wide(spark, sf), models, w).select("id", F.lit("test").alias("split"), "blend")
    return _round_doubles(oof.unionByName(tst))


# ---------------------------------------------------------------- ranking
def q_rank_norm_oof(spark, sf):
    r = ranknorm.average_rank(oof_long(spark, sf), ["model"])
    return _round_doubles(r.select("model", "id", "rank_norm"))


def q_rank_norm_ordinal(spark, sf):
    r = ranknorm.ordinal_rank(oof_long(spark, sf), ["model"])
    return _round_doubles(r.select("model", "id", "rank_norm"))


def q_rank_norm_test(spark, sf):
    knots = ranknorm.rank_knots(oof_long(spark, sf), ["model"])
    r = ranknorm.interpolate(knots, test_long(spark, sf), ["model"])
    return _round_doubles(r.select("model", "id", "rank_norm"))


# ---------------------------------------------------------------- pseudo labels
def q_pseudo_select(spark, sf):
    from raretide.operators import pseudo
    return pseudo.select_pseudo(test_wide(spark, sf).select("id", F.col("m1").alias("score")))


def q_pseudo_gate(spark, sf):
    from raretide.operators import pseudo
    return pseudo.gate(test_wide(spark, sf).select("id", F.col("m1").alias("score")))


# ---------------------------------------------------------------- oversampling
def _smote_input(spark, sf):
    from raretide.operators.folds import stratified_folds
    train, _ = split(spark, sf)
    f = stratified_folds(train, 5, 42, keep_rank=True)
    return impute.MedianImputer(FEATURES).fit(train).transform(f)


def q_smote_knn(spark, sf):
    from raretide.operators import neighbours
    t = _smote_input(spark, sf)
    pos = t.filter(F.col("target") == 1).select("id", "fold", F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("vec"))
    nn = neighbours.split_neighbours(pos, 5, k=5)
    return nn.select(F.col("tf").cast("int").alias("tf"), "id", "rank", "nn_id", r6("dist").alias("dist"))


def q_smote_check(spark, sf):
    from raretide.operators import resample
    t = _smote_input(spark, sf)
    syn, _ = resample.oversample(t, FEATURES, 5, ratio=0.10, k=5)
    made = syn.groupBy("tf").agg(F.count(F.lit(1)).alias("n_made"))
    cnt = resample.synthetic_counts(t, 5, 0.10)
    out = cnt.join(made, "tf", "left").select(
        F.col("tf").cast("int").alias("tf"), F.col("n_pos").cast("long").alias("n_pos"),
        F.col("n_neg").cast("long").alias("n_neg"), F.coalesce("n_made", F.lit(0)).cast("long").alias("n_syn"))
    return out.select("*", r6((F.col("n_pos") + F.col("n_syn")) / (F.col("n_pos") + F.col("n_syn") + F.col("n_neg")))
                      .alias("share_after"))


def q_smote_draws(spark, sf):
    from raretide.operators import resample
    syn, _ = resample.oversample(_smote_input(spark, sf), FEATURES, 5, ratio=0.10, k=5)
    return _round_doubles(syn.select(F.col("tf").cast("int").alias("tf"), "syn_id", "base_id", "nn_id", "u", *FEATURES))


def _engineer_version(v):
    def query(spark, sf):
        train, _ = split(spark, sf)
        spec = FIXTURE_PRESETS[v]
        detected = profile.detect_binary(train, FEATURES) if spec.auto_binary else None
        e = fx.engineer(train, spec, FEATURES, detected)
        return _pick(e, [c for c in e.columns if c != "id"])
    return query


def q_nulls_finished(spark, sf):
    """Null cells of the engineered and encoded training matrix, before and after imputation."""
    f, test, m = _te_model(spark, sf)
    raw = m.transform_oof(fx.engineer(f, FIXTURE, FEATURES))
    cols = [c for c in raw.columns if c not in ("id", "target", "fold")]
    full = impute.MedianImputer(cols).fit(raw).transform(raw)
    before = profile.nulls_remaining(raw, cols).select(F.col("n_null").alias("n_null_before"))
    return profile._one_row_join(profile.nulls_remaining(full, cols), before)


def q_te_nested(spark, sf):
    f = folded_train(spark, sf)
    _, test = split(spark, sf)
    m = encode.NestedTargetEncoder(TE_COLS, K_FOLDS, smooth=30, n_bins=20).fit(f, test)
    names = [f"te_{c}" for c in TE_COLS]
    parts = [m.transform_train(f, o).select(F.lit(o).alias("outer_fold"), "id", *names) for o in range(K_FOLDS)]
    return _round_doubles(reduce(DataFrame.unionByName, parts).unpivot(["outer_fold", "id"], names, "col", "te"))


def _stumps(spark, sf):
    from raretide.operators import stump
    train, test = split(spark, sf)
    spw = profile.target_profile(train).first()["scale_pos_weight"]  # one number
    return stump.stump_scores(folded_train(spark, sf), test, FEATURES, K_FOLDS, spw)


def q_stump_oof(spark, sf):
    return _round_doubles(_stumps(spark, sf)[0])


def q_stump_test_mean(spark, sf):
    return _round_doubles(_stumps(spark, sf)[1])


def q_meta_stack(spark, sf):
    from raretide.operators import learners
    oof_s, tst = learners.meta_stack(oof_wide(spark, sf), test_wide(spark, sf), ["m1", "m2"])
    return _round_doubles(oof_s.select("id", F.lit("oof").alias("split"), "meta").unionByName(
        tst.select("id", F.lit("test").alias("split"), "meta")))


def q_isotonic(spark, sf):
    from raretide.operators import calibrate
    oof = oof_wide(spark, sf).select("id", "target", F.col("m1").alias("score"))
    model = calibrate.fit_isotonic(oof)
    out = calibrate.apply_isotonic(model, test_wide(spark, sf).select("id", F.col("m1").alias("score")))
    return _round_doubles(out.select("id", "score", "calibrated"), keep=("score",))


SQL_QUERIES: dict[str, Query] = {
    "scan_entities": q_scan_entities,
    "profile_target": q_profile_target,
    "profile_missing": q_profile_missing,
    "binary_columns": q_binary_columns,
    "smote_preview": q_smote_preview,
    "score_summary": q_score_summary,
    "score_head": q_score_head,
    "nulls_after_impute": q_nulls_after_impute,
    "metric_report": q_metric_report,
    "feat_missing_flags": q_feat_missing_flags,
    "feat_row_counts": q_feat_row_counts,
    "feat_row_stats": q_feat_row_stats,
    "feat_row_shape": q_feat_row_shape,
    "feat_binary_agg": q_feat_binary_agg,
    "feat_pairwise": q_feat_pairwise,
    "feat_ratios": q_feat_ratios,
    "feat_poly_log": q_feat_poly_log,
    "feat_interactions": q_feat_interactions,
    "engineer_v4": q_engineer_v4,
    "te_edges": q_te_edges,
    "te_bins": q_te_bins,
    "te_fold_stats": q_te_fold_stats,
    "te_oof": q_te_oof,
    "te_test": q_te_test,
    "impute_median": q_impute_median,
    "standardise_scores": q_standardise_scores,
    "stratified_folds": q_stratified_folds,
    "fold_sizes": q_fold_sizes,
    "class_weights": q_class_weights,
    "roc_auc": q_roc_auc,
    "average_precision": q_average_precision,
    "metric_by_fold": q_metric_by_fold,
    "blend2_auc": q_blend2_auc,
    "blend3_ap": q_blend3_ap,
    "blend4_ap": q_blend4_ap,
    "blend_apply": q_blend_apply,
    "rank_norm_oof": q_rank_norm_oof,
    "rank_norm_ordinal": q_rank_norm_ordinal,
    "rank_norm_test": q_rank_norm_test,
    "pseudo_select": q_pseudo_select,
    "pseudo_gate": q_pseudo_gate,
    "smote_knn": q_smote_knn,
    "smote_check": q_smote_check,
    "blend_search3": q_blend_search3,
    "blend_search4": q_blend_search4,
    "scan_csv": q_scan_csv,
    "smote_draws": q_smote_draws,
    "engineer_v1": _engineer_version(1),
    "engineer_v2": _engineer_version(2),
    "engineer_v3": _engineer_version(3),
    "nulls_finished": q_nulls_finished,
    "te_nested": q_te_nested,
    "stump_oof": q_stump_oof,
    "stump_test_mean": q_stump_test_mean,
    "meta_stack": q_meta_stack,
    "isotonic": q_isotonic,
    "tail_meta": lambda spark, sf: q_tail_meta(spark, sf),
    "tail_isotonic": lambda spark, sf: q_tail_isotonic(spark, sf),
    "tail_ordinal": lambda spark, sf: q_tail_ordinal(spark, sf),
    "stage_resume": lambda spark, sf: q_stage_resume(spark, sf),
    "final_select": lambda spark, sf: q_final_select(spark, sf),
    "submission": lambda spark, sf: q_submission(spark, sf),
}
# ---------------------------------------------------------------- rows-only (learners, draws, sinks)
def _plan(spark, sf):
    from raretide.plans import pipeline
    cfg = pipeline.PlanConfig(members=[])
    tr, ts, feats, spw, key = pipeline.features_stage(spark, sf, cfg)
    return pipeline, cfg, tr, ts, feats, spw, key


def _member_cv(spark, sf, name, max_iter=None):
    """Scores and metrics of one member as the plan fits it: SMOTE rows, best prefix, the plan's number of trees."""
    from raretide.operators import learners
    pl, cfg, tr, ts, feats, spw, key = _plan(spark, sf)
    syn = pl.smote_stage(spark, tr, feats, cfg, key)
    m = learners.member(name, max_iter or pl.TREES)
    scores = pl.member_stage(spark, tr, ts, feats, m, cfg, spw, syn, key)
    return *scores, m, pl.member_metrics(spark, m, cfg, syn, key)


def q_smote_sample(spark, sf):
    pl, cfg, tr, ts, feats, spw, key = _plan(spark, sf)
    return pl.smote_stage(spark, tr, feats, cfg, key).select("tf", "syn_id", "base_id", "nn_id", "u",
                                                            *[c for c in FEATURES])


def q_gbt_oof(spark, sf):
    return _member_cv(spark, sf, "lgb")[0]


def q_test_fold_mean(spark, sf):
    return _member_cv(spark, sf, "lgb")[1]


def q_rf_oof(spark, sf):
    from raretide.plans import pipeline
    return _member_cv(spark, sf, "rf", pipeline.FOREST_TREES)[0]


def q_gbt_presets(spark, sf):
    """AP and AUC per fold of the three histogram presets, from their commit records."""
    rows = []
    for name in ("hgb_a", "hgb_b", "hgb_c"):
        got = _member_cv(spark, sf, name)[3]
        rows += [(name, f, got["ap", f], got["auc", f]) for f in range(K_FOLDS)]
    return spark.createDataFrame(rows, "model string, fold int, ap double, auc double")


def q_best_iteration(spark, sf):
    _, _, m, got = _member_cv(spark, sf, "lgb")
    return spark.createDataFrame([(f, int(got["best_iteration", f]), m.max_iter) for f in range(K_FOLDS)], "fold int, best_iter int, max_iter int")


def q_random_search(spark, sf):
    """Every evaluation of the plan's parameter search (inner folds with their own synthetic rows)."""
    from raretide.operators import learners
    from raretide.sources.stages import fingerprint, stage
    pl, cfg, tr, ts, feats, spw, key = _plan(spark, sf)
    cfg.search_trials = SEARCH_TRIALS
    m = learners.member("lgb", pl.TREES)
    pl.search_stage(spark, tr, feats, m, cfg, spw, key)
    return stage(spark, "search", fingerprint(key, m.name, m.params, m.max_iter, cfg.search_trials, cfg.search_folds, cfg.smote_ratio, cfg.k_nn), lambda: None)


def _tail(spark, sf, models, tail, steps):
    from raretide.plans import pipeline
    done = pipeline.finish(oof_wide(spark, sf), test_wide(spark, sf), models, tail, steps)
    return done.final.select("id", "score", F.lit(done.method).alias("method"))


def _standin_final(spark, sf):
    return _tail(spark, sf, ["m1", "m2", "m3"], "rank", 20)


def q_tail_meta(spark, sf):
    return _round_doubles(_tail(spark, sf, ["m1", "m2"], "meta", 100))


def q_tail_isotonic(spark, sf):
    return _round_doubles(_tail(spark, sf, ["m1", "m2"], "isotonic", 200))


def q_tail_ordinal(spark, sf):
    return _round_doubles(_tail(spark, sf, ["m1", "m2", "m3"], "ordinal", 20))


def q_final_select(spark, sf):
    return _round_doubles(_standin_final(spark, sf))


def q_submission(spark, sf):
    import uuid
    from raretide.session import checkpoint_root
    from raretide.sources import sink
    path = f"{checkpoint_root(spark)}/submission-{uuid.uuid4().hex[:8]}"
    sink.write_submission(_round_doubles(_standin_final(spark, sf)), path)
    return spark.read.option("header", True).schema("id long, target double").csv(path)


def q_stage_resume(spark, sf):
    import uuid
    from raretide.sources import stages
    fp = uuid.uuid4().hex[:12]
    log = []
    calls = {"n": 0}

    def build():
        calls["n"] += 1
        return entity_features(spark, sf)

    for step, f in ((1, fp), (2, fp), (3, fp + "x")):
        before = calls["n"]
        n = stages.stage(spark, "resume_check", f, build).count()
        log.append((step, f != fp, calls["n"] > before, n))
    return spark.createDataFrame(log, "step int, fingerprint_changed boolean, rebuilt boolean, n_rows long")


def q_pseudo_refit(spark, sf):
    from raretide.operators import pseudo
    from raretide.sources.stages import fingerprint, stage
    base_oof, _, m, got = _member_cv(spark, sf, "lgb")
    pl, cfg, tr, ts, feats, spw, key = _plan(spark, sf)
    # The stand-in scores of m2 open the gate at every scale factor; the fits are real.
    sure = test_wide(spark, sf).select("id", F.col("m2").alias("score"))
    gate = pseudo.gate(sure).first()
    base_ap, schema = got["ap", None], "model string, n_pseudo long, base_ap double, refit_ap double, kept boolean"
    if not gate["use_pseudo"]:
        return spark.createDataFrame([(m.name, int(gate["n_pseudo"]), float(base_ap), None, False)], schema)
    rows_key = fingerprint(key, "m2")
    # written once: every fold's fit reads both several times
    rows = stage(spark, "pseudo_rows", rows_key, lambda: pseudo.select_pseudo(sure).join(ts, "id").withColumnRenamed("pseudo_label", "target"))
    syn = pl.smote_stage(spark, tr, feats, cfg, key, rows, rows_key)
    refit_ap = metrics.average_precision(pl.member_cv(tr, ts, feats, m, cfg, spw, syn, rows).oof, []).first()["ap"]
    return spark.createDataFrame([(m.name, int(gate["n_pseudo"]), float(base_ap), float(refit_ap), pseudo.keep_refit(base_ap, refit_ap))], schema)


def q_score_plan(spark, sf):
    """The whole checkpoint-edition plan on the fixture (3 members, SMOTE, blend, rank norm)."""
    from raretide.plans import pipeline
    return pipeline.run(spark, sf).final


ROWS_QUERIES: dict[str, Query] = {
    "smote_sample": q_smote_sample,
    "gbt_oof": q_gbt_oof,
    "test_fold_mean": q_test_fold_mean,
    "rf_oof": q_rf_oof,
    "gbt_presets": q_gbt_presets,
    "best_iteration": q_best_iteration,
    "random_search": q_random_search,
    "pseudo_refit": q_pseudo_refit,
    "score_plan": q_score_plan,
}
