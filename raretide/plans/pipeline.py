"""The end-to-end scoring plan, resumable stage by stage.

prepare   engineer (one projection) -> stratified folds -> out-of-fold target
          encoding (nested per validation fold with ``leak_safe``) -> median
          imputation; written as the ``features`` stage
search    optional: rungs of parameter trials on inner folds with their own synthetic
          rows; the winner's parameters replace those of the first member
members   per member: k-fold CV (+ SMOTE rows per training split), boosted members
          scored at their best prefix -> OOF and fold-averaged test scores; one stage
          per member, with its metrics in the commit record
scores    one row per id with a column per member, written once
tail      "rank"      AP blend, average rank normalisation kept when its AP is not lower
          "ordinal"   the same with ordinal ranks
          "isotonic"  AUC blend, isotonic calibration
          "meta"      AUC blend or the stacked regression, whichever has the higher AUC
pseudo    optional, before the tail: confident test rows join every training split before its
          synthetic rows are made; kept only if the first member's OOF AP
          improves (weights unchanged)
sink      ``id,target`` CSV written in parallel

Every stage fingerprint covers the input location and all parameters; a
rerun reads finished stages and builds only what is missing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.functions.features import engineer
from raretide.operators import blend, calibrate, profile, pseudo, ranknorm, resample
from raretide.operators.encode import NestedTargetEncoder, TargetEncoder
from raretide.operators.folds import stratified_folds
from raretide.operators.impute import MedianImputer, columns_with_nulls
from raretide.operators.learners import CVResult, Member, cross_val, fold_metrics, member, meta_stack, rung_search
from raretide.operators.metrics import average_precision, roc_auc
from raretide.sources.entities import entity_schema, scan_csv, train_test
from raretide.sources.sink import write_submission
from raretide.sources.stages import fingerprint, input_key, stage, stage_metrics
from raretide.spec import FIXTURE, FeatureSpec


#: Trees of a boosted member at most (early stopping keeps fewer) and of a forest: parameters, not limits of the method.
TREES, FOREST_TREES = 20, 40


@dataclass
class PlanConfig:
    spec: FeatureSpec = FIXTURE
    k_folds: int = 5
    seed: int = 42
    smooth: float = 30.0
    n_bins: int = 20
    smote_ratio: float | None = 0.10
    k_nn: int = 5
    members: list[Member] = field(default_factory=lambda: [member("lgb", TREES), member("xgb", TREES), member("cat", TREES)])
    blend_steps: int = 20
    tail: str = "rank"
    use_pseudo: bool = False
    early_stop: bool = True
    exact_quantiles: bool = True
    leak_safe: bool = False
    search_trials: int = 0
    search_folds: int = 3

    def key(self) -> str:
        """Fingerprint of everything the prepared tables depend on."""
        return fingerprint(self.spec, self.k_folds, self.seed, self.smooth, self.n_bins, self.exact_quantiles, self.leak_safe)


META = ("id", "target", "fold", "class_rank")


def engineered(train: DataFrame, test: DataFrame, cfg: PlanConfig) -> tuple[DataFrame, DataFrame]:
    """Row features (one projection each) and folds of the train side."""
    raw = [c for c in train.columns if c not in ("id", "target")]
    detected = profile.detect_binary(train, raw) if cfg.spec.auto_binary else None
    # The folds' window shuffles and sorts the raw columns; engineering is a narrow projection after it.
    tr = engineer(stratified_folds(train, cfg.k_folds, cfg.seed, keep_rank=True), cfg.spec, raw, detected)
    ts = engineer(test, cfg.spec, raw, detected)
    return tr, ts


def encoded(tr: DataFrame, ts: DataFrame, cfg: PlanConfig) -> tuple[DataFrame, DataFrame, list[str]]:
    """Out-of-fold target encoding and median imputation of engineered tables."""
    te_cols = [c for c in cfg.spec.te_cols if c in tr.columns]
    if te_cols and cfg.leak_safe:
        nested = NestedTargetEncoder(te_cols, cfg.k_folds, cfg.smooth, cfg.n_bins, exact=cfg.exact_quantiles).fit(tr, ts)
        tr, ts = nested.transform_all(tr, True), nested.transform_all(ts, False)
    elif te_cols:
        enc = TargetEncoder(te_cols, cfg.smooth, cfg.n_bins, exact=cfg.exact_quantiles).fit(tr, ts)
        tr, ts = enc.transform_oof(tr), enc.transform_test(ts)
    feats = [c for c in tr.columns if c not in META]
    tr = tr.select(*[F.col(c).cast("double").alias(c) if c in feats else F.col(c) for c in tr.columns])
    ts = ts.select("id", *[F.col(c).cast("double").alias(c) for c in feats])
    holes = columns_with_nulls([tr, ts], feats)
    if not holes:
        return tr, ts, feats
    imp = MedianImputer(holes, exact=cfg.exact_quantiles).fit(tr)
    return imp.transform(tr), imp.transform(ts), feats


def prepare(train: DataFrame, test: DataFrame, cfg: PlanConfig) -> tuple[DataFrame, DataFrame, list[str]]:
    """Engineered, encoded, imputed train (with fold/class_rank) and test tables."""
    tr, ts = engineered(train, test, cfg)
    return encoded(tr, ts, cfg)


def _sides(tr: DataFrame, ts: DataFrame) -> DataFrame:
    return tr.withColumn("__side", F.lit("train")).unionByName(ts.withColumn("__side", F.lit("test")),
                                                              allowMissingColumns=True)


@dataclass
class PlanResult:
    features: list[str]
    oof: DataFrame
    test: DataFrame
    weights: list[float]
    member_ap: dict[str, float]
    blend_ap: float
    norm_ap: float
    final: DataFrame
    used_rank_norm: bool
    pseudo_kept: bool | None = None
    method: str = ""


def _ap(df: DataFrame, score: str = "score") -> float:
    r = average_precision(df.select("target", F.col(score).alias("score")), []).first()
    return float(r["ap"]) if r and r["ap"] is not None else float("nan")


def _auc(df: DataFrame, score: str) -> float:
    r = roc_auc(df.select("target", F.col(score).alias("score")), []).first()
    return float(r["auc"]) if r and r["auc"] is not None else float("nan")


def model_features(feats: list[str], cfg: PlanConfig) -> tuple[list[str], dict[str, str]]:
    """(features of a model, those that differ by validation fold) from the columns of the prepared tables."""
    if not cfg.leak_safe:
        return feats, {}
    nested = {c[:c.rindex("__o")]: c[:c.rindex("__o")] + "__o{}" for c in feats if c.startswith("te_") and "__o" in c}
    return [c for c in feats if "__o" not in c] + list(nested), nested


def features_stage(spark: SparkSession, sf_dir: str, cfg: PlanConfig) -> tuple[DataFrame, DataFrame, list[str], float, str]:
    """:func:`prepared_stage` of the fixture's train and test side."""
    from raretide.plans.fixture import inputs_key
    return prepared_stage(*train_test(spark, sf_dir), cfg, inputs_key(spark, sf_dir))


def prepared_stage(train: DataFrame, test: DataFrame, cfg: PlanConfig, data_key: str) -> tuple[DataFrame, DataFrame, list[str], float, str]:
    """The prepared train/test tables as a stage: ``(train, test, features, spw, key)``.

    ``data_key`` names the data (see :func:`raretide.sources.stages.input_key`).
    """
    spark = train.sparkSession
    key = fingerprint(data_key, cfg.key())

    def build_features() -> DataFrame:
        # The engineered tables are written first: the encoder and imputer fits
        # (small collected results) then read them instead of recomputing joins.
        eng = stage(spark, "engineered", key, lambda: _sides(*engineered(train, test, cfg)), partition_by=["__side"])
        e_tr = eng.filter(F.col("__side") == "train").drop("__side")
        e_ts = eng.filter(F.col("__side") == "test").drop("__side", "target", "fold", "class_rank")
        tr, ts, _ = encoded(e_tr, e_ts, cfg)
        return _sides(tr, ts)

    def measure(table: DataFrame) -> list:
        row = profile.target_profile(table.where(F.col("__side") == "train")).first()
        return [("", None, "scale_pos_weight", float(row["scale_pos_weight"]))]

    both = stage(spark, "features", key, build_features, partition_by=["__side"], metrics=measure)
    feats = [c for c in both.columns if c not in META + ("__side",)]
    tr = both.filter(F.col("__side") == "train").drop("__side")
    ts = both.filter(F.col("__side") == "test").select("id", *feats)
    spw = next(v for _, _, name, v in stage_metrics(spark, "features", key) if name == "scale_pos_weight")
    return tr, ts, feats, spw, key


def neighbour_stage(spark: SparkSession, tr: DataFrame, feats: list[str], cfg: PlanConfig, key: str) -> DataFrame:
    """The neighbour table of the minority rows, for all splits; a refit only adds its rows."""
    near = [c for c in feats if "__o" not in c]

    def build() -> DataFrame:
        vec = F.array(*[F.col(c).cast("double") for c in near])
        points = tr.where(F.col("target") == 1).select("id", "fold", vec.alias("vec"))
        return resample.split_neighbours(points, cfg.k_folds, cfg.k_nn)
    return stage(spark, "neighbours", fingerprint(key, cfg.k_nn), build)


def smote_stage(spark: SparkSession, tr: DataFrame, feats: list[str], cfg: PlanConfig, key: str, extra: DataFrame | None = None,
                extra_key: str | None = None) -> DataFrame:
    """Synthetic rows of every split; with ``extra`` rows, which every split then holds, kept as a stage if ``extra_key`` names them."""
    near = [c for c in feats if "__o" not in c]
    near = near if len(near) < len(feats) else None

    def build_syn() -> DataFrame:
        table = neighbour_stage(spark, tr, feats, cfg, key)
        return resample.oversample(tr, feats, cfg.k_folds, cfg.smote_ratio, cfg.k_nn, cfg.seed, neighbours=table, extra=extra, near=near)[0]
    if extra is None:
        return stage(spark, "smote", fingerprint(key, cfg.smote_ratio, cfg.k_nn), build_syn)
    if extra_key is None:
        return build_syn()
    return stage(spark, "smote_extra", fingerprint(key, cfg.smote_ratio, cfg.k_nn, extra_key), build_syn)


def search_stage(spark: SparkSession, tr: DataFrame, feats: list[str], base: Member, cfg: PlanConfig, spw: float, key: str) -> Member:
    """``base`` with the parameters of the search's winner; the evaluations are a stage, the winner is in its record."""
    names, nested = model_features(feats, cfg)
    names = [c for c in names if c not in nested]  # inner folds are others than those the nested encodings know
    fp = fingerprint(key, base.name, base.params, base.max_iter, cfg.search_trials, cfg.search_folds, cfg.smote_ratio, cfg.k_nn)
    found: dict = {}

    def build() -> DataFrame:
        inner = stage(spark, "search_folds", fp, lambda: stratified_folds(tr.drop("fold", "class_rank"), cfg.search_folds, cfg.seed, keep_rank=True))
        syn = None
        if cfg.smote_ratio:
            syn = stage(spark, "search_smote", fp, lambda: resample.oversample(inner, names, cfg.search_folds, cfg.smote_ratio, cfg.k_nn, cfg.seed)[0])
        table, winner = rung_search(inner, names, base, cfg.search_folds, spw, cfg.search_trials, cfg.seed, synthetic=syn)
        found.update(winner)
        return table

    stage(spark, "search", fp, build, metrics=lambda _: [(base.name, None, k, v) for k, v in found.items()])
    winner = {k: v for _, _, k, v in stage_metrics(spark, "search", fp)}
    return Member(base.name, {**base.params, **winner}, base.max_iter)


def member_key(m: Member, cfg: PlanConfig, synthetic: DataFrame | None, key: str) -> str:
    return fingerprint(key, m.name, m.params, m.max_iter, cfg.early_stop, None if synthetic is None else (cfg.smote_ratio, cfg.k_nn))


def member_cv(tr: DataFrame, ts: DataFrame, feats: list[str], m: Member, cfg: PlanConfig, spw: float, synthetic: DataFrame | None,
              extra: DataFrame | None = None) -> CVResult:
    names, nested = model_features(feats, cfg)
    return cross_val(tr, ts, names, m, cfg.k_folds, spw, synthetic, cfg.seed, early_stop=cfg.early_stop, extra_train=extra, per_fold=nested)


def member_stage(spark: SparkSession, tr: DataFrame, ts: DataFrame, feats: list[str], m: Member, cfg: PlanConfig,
                 spw: float, synthetic: DataFrame | None, key: str) -> tuple[DataFrame, DataFrame]:
    """``(oof, test)`` scores of one member, built once per fingerprint; its metrics are in the commit record."""
    iters: dict[int, int] = {}

    def build_member() -> DataFrame:
        cv = member_cv(tr, ts, feats, m, cfg, spw, synthetic)
        iters.update(cv.best_iters)
        return cv.oof.withColumn("__side", F.lit("oof")).unionByName(
            cv.test.withColumn("__side", F.lit("test")), allowMissingColumns=True)

    def measure(table: DataFrame) -> list:
        oof = table.where(F.col("__side") == "oof")
        rows = [(m.name, None, "ap", _ap(oof)), (m.name, None, "auc", _auc(oof, "score"))]
        rows += [(m.name, int(r["fold"]), n, r[n]) for r in fold_metrics(oof).collect() for n in ("ap", "auc")]
        return rows + [(m.name, f, "best_iteration", float(n)) for f, n in sorted(iters.items())]

    mt = stage(spark, f"member_{m.name}", member_key(m, cfg, synthetic, key), build_member, metrics=measure)
    return (mt.filter(F.col("__side") == "oof").drop("__side"),
            mt.filter(F.col("__side") == "test").select("id", "model", "score"))


def member_metrics(spark: SparkSession, m: Member, cfg: PlanConfig, synthetic: DataFrame | None, key: str) -> dict[tuple[str, int | None], float]:
    """``{(metric, fold): value}`` of a finished member, read from its record without a job."""
    rows = stage_metrics(spark, f"member_{m.name}", member_key(m, cfg, synthetic, key)) or []
    return {(name, fold): value for _, fold, name, value in rows}


def wide_stage(spark: SparkSession, oof: DataFrame, tst: DataFrame, names: list[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(oof, test) scores with one row per id and a column per member, written once for all that reads them."""
    def build() -> DataFrame:
        return blend.pivot_scores(oof, names, ["id", "target"]).withColumn("__side", F.lit("oof")).unionByName(
            blend.pivot_scores(tst, names, ["id"]).withColumn("__side", F.lit("test")), allowMissingColumns=True)
    both = stage(spark, "scores", key, build, partition_by=["__side"])
    return both.where(F.col("__side") == "oof").drop("__side"), both.where(F.col("__side") == "test").drop("__side", "target")


@dataclass
class Tail:
    weights: list[float]
    blend_metric: float
    other_metric: float
    method: str
    final: DataFrame


def best_blend(oof_w: DataFrame, names: list[str], steps: int, metric: str) -> list[float]:
    best = blend.search(oof_w, names, steps, metric).first()
    return [best[w] / steps for w in blend.weight_names(len(names))]


def finish(oof_w: DataFrame, tst_w: DataFrame, names: list[str], tail: str = "rank", steps: int = 20, weights: list[float] | None = None) -> Tail:
    """Final test scores ``(id, score)`` of wide member scores by one of the published tails (see the module)."""
    if tail not in ("rank", "ordinal", "isotonic", "meta"):
        raise ValueError(f"no tail is called {tail}")
    weights = weights or best_blend(oof_w, names, steps, "ap" if tail in ("rank", "ordinal") else "auc")
    oof_b = blend.apply_weights(oof_w, names, weights, "score").withColumn("__k", F.lit(0))
    tst_b = blend.apply_weights(tst_w, names, weights, "score").withColumn("__k", F.lit(0))
    plain = tst_b.select("id", "score")
    if tail == "meta":
        mine = _auc(oof_b, "score")
        meta_oof, meta_tst = meta_stack(oof_w, tst_w, names)
        other = _auc(meta_oof, "meta")
        if other >= mine:
            return Tail(weights, mine, other, "meta", meta_tst.select("id", F.col("meta").alias("score")))
        return Tail(weights, mine, other, "blend", plain)
    if tail == "isotonic":
        model = calibrate.fit_isotonic(oof_b)
        done = calibrate.apply_isotonic(model, plain).select("id", F.col("calibrated").alias("score"))
        return Tail(weights, _auc(oof_b, "score"), float("nan"), "isotonic", done)
    mine = _ap(oof_b)
    if tail == "ordinal":
        ranked = ranknorm.ordinal_rank(oof_b, ["__k"], out="norm")
        mapped = ranknorm.interpolate_ordinal(ranknorm.ordinal_knots(oof_b, ["__k"]), tst_b.select("id", "score", "__k"), ["__k"], out="final")
    else:
        ranked = ranknorm.average_rank(oof_b, ["__k"], out="norm")
        mapped = ranknorm.interpolate(ranknorm.rank_knots(oof_b, ["__k"]), tst_b.select("id", "score", "__k"), ["__k"], out="final")
    other = _ap(ranked, "norm")
    if other >= mine:
        return Tail(weights, mine, other, "rank_norm", mapped.select("id", F.col("final").alias("score")))
    return Tail(weights, mine, other, "blend", plain)


def run(spark: SparkSession, sf_dir: str, cfg: PlanConfig | None = None, out_path: str | None = None) -> PlanResult:
    """The plan on the fixture tables."""
    from raretide.plans.fixture import inputs_key
    return run_tables(*train_test(spark, sf_dir), cfg, inputs_key(spark, sf_dir), out_path)


def run_csv(spark: SparkSession, train_path: str, test_path: str, n_features: int, cfg: PlanConfig | None = None,
            out_path: str | None = None) -> PlanResult:
    """The plan on two CSV files with header ``id, [target,] feature_1..feature_n``, in any column order."""
    train = scan_csv(spark, train_path, entity_schema(n_features))
    test = scan_csv(spark, test_path, entity_schema(n_features, with_target=False))
    return run_tables(train, test, cfg, input_key(spark, [train_path, test_path]), out_path)


def run_tables(train: DataFrame, test: DataFrame, cfg: PlanConfig | None, data_key: str, out_path: str | None = None) -> PlanResult:
    """The plan on any train table (``id``, ``target``, features) and test table (``id``, features)."""
    cfg = cfg or PlanConfig()
    spark = train.sparkSession
    tr, ts, feats, spw, key = prepared_stage(train, test, cfg, data_key)
    synthetic = smote_stage(spark, tr, feats, cfg, key) if cfg.smote_ratio else None
    members = list(cfg.members)
    if cfg.search_trials:
        members[0] = search_stage(spark, tr, feats, members[0], cfg, spw, key)
    parts = {m.name: member_stage(spark, tr, ts, feats, m, cfg, spw, synthetic, key) for m in members}
    names = [m.name for m in members]
    member_ap = {m.name: member_metrics(spark, m, cfg, synthetic, key)["ap", None] for m in members}
    wide_key = fingerprint(*[member_key(m, cfg, synthetic, key) for m in members])

    def wide(parts: dict, key: str) -> tuple[DataFrame, DataFrame]:
        return wide_stage(spark, _union([o for o, _ in parts.values()]), _union([t for _, t in parts.values()]), names, key)

    oof_w, tst_w = wide(parts, wide_key)
    weights, kept = None, None
    if cfg.use_pseudo:
        weights = best_blend(oof_w, names, cfg.blend_steps, "ap" if cfg.tail in ("rank", "ordinal") else "auc")
        sure = blend.apply_weights(tst_w, names, weights, "score")
        if pseudo.gate(sure).first()["use_pseudo"]:
            rows = pseudo.select_pseudo(sure).join(ts, "id").withColumnRenamed("pseudo_label", "target")
            rows_key = fingerprint(wide_key, weights)
            chosen = rows
            rows = stage(spark, "pseudo_rows", rows_key, lambda: chosen)
            # every fold's fit reads the rows several times
            syn = smote_stage(spark, tr, feats, cfg, key, rows, rows_key) if cfg.smote_ratio else None
            cv = member_cv(tr, ts, feats, members[0], cfg, spw, syn, rows)
            kept = pseudo.keep_refit(member_ap[names[0]], _ap(cv.oof))
            if kept:
                parts[names[0]] = (cv.oof, cv.test.select("id", "model", "score"))
                oof_w, tst_w = wide(parts, fingerprint(wide_key, weights, "refit"))
    done = finish(oof_w, tst_w, names, cfg.tail, cfg.blend_steps, weights)
    if out_path:
        write_submission(done.final, out_path)
    oof = oof_w.unpivot(["id", "target"], names, "model", "score")
    return PlanResult(feats, oof, tst_w.unpivot(["id"], names, "model", "score"), done.weights, member_ap, done.blend_metric, done.other_metric,
                      done.final, done.method == "rank_norm", kept, done.method)


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
