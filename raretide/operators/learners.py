"""Learners on Spark ML: class-weighted trees, out-of-fold scoring, stacking, search.

The reference's boosters are re-aimed onto ``GBTClassifier`` (and a random
forest for the dropout-boosting slot); tree-level parity is a non-goal.
Parameter mapping: learning rate -> ``stepSize``, trees -> ``maxIter``,
depth -> ``maxDepth``, min leaf size -> ``minInstancesPerNode``, row
subsample -> ``subsamplingRate``, column fraction -> ``featureSubsetStrategy``,
min split gain -> ``minInfoGain``, bins -> ``maxBins``.  Leaf counts map to
depth (63 -> 6, 31 -> 5, 47 -> 6); l1/l2 leaf terms have no equivalent.

Cross-validation keeps everything keyed by ``id``: per fold the model is fit
on ``fold != f`` (plus that split's synthetic rows), scores ``fold == f``
and the test table; out-of-fold scores are the union of the validation
scores, test scores the mean over fold models (``groupBy(id).avg``).  Every
fit is a distributed Spark ML job; the driver only loops over folds.

Early stopping fits a boosted model once: its trees were added one by one, so the
model of the first n trees is a prefix of it.  One pass over the validation fold gives
the loss after every tree, and the best prefix scores (:func:`prefix_model`).

The parameter search runs in rungs: all trials with few trees, the best ones again with
more, until few are left (:func:`rung_search`); the winner's parameters replace the
member's own.
"""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.operators.metrics import average_precision, roc_auc

# The v3 histogram-GBT presets A/B/C (learning rate, leaves -> depth,
# min leaf size, bins 127, seed offsets 0/1/2) and the checkpoint-edition members.
PRESETS = {
    "hgb_a": dict(kind="gbt", stepSize=0.08, maxDepth=6, minInstancesPerNode=30, maxBins=127, seed_offset=0),
    "hgb_b": dict(kind="gbt", stepSize=0.12, maxDepth=5, minInstancesPerNode=50, maxBins=127, seed_offset=1),
    "hgb_c": dict(kind="gbt", stepSize=0.06, maxDepth=6, minInstancesPerNode=40, maxBins=127, seed_offset=2),
    "lgb": dict(kind="gbt", stepSize=0.025, maxDepth=8, minInstancesPerNode=30, subsamplingRate=0.75,
                featureSubsetStrategy="0.7", minInfoGain=0.01),
    "xgb": dict(kind="gbt", stepSize=0.025, maxDepth=7, subsamplingRate=0.7, featureSubsetStrategy="0.7",
                minInfoGain=0.1, minInstancesPerNode=10),
    "cat": dict(kind="gbt", stepSize=0.025, maxDepth=8),
    "rf": dict(kind="rf", maxDepth=8, minInstancesPerNode=20, subsamplingRate=0.7, featureSubsetStrategy="sqrt"),
}


#: Rows a partition of a fit may hold before a fit takes more partitions than there are cores.
FIT_ROWS = 250_000
#: Bytes that a fit keeps of a row besides four per feature, and the share of the storage memory that fits may fill.
FIT_ROW_BYTES, FIT_SHARE = 200, 0.8


@dataclass
class Member:
    """One ensemble member: a named parameter map for a tree learner."""

    name: str
    params: dict = field(default_factory=dict)
    max_iter: int = 20

    def estimator(self, seed: int = 42, label: str = "label", weight: str | None = "weight"):
        p = dict(self.params)
        kind = p.pop("kind", "gbt")
        off = p.pop("seed_offset", 0)
        common = dict(featuresCol="features", labelCol=label, seed=seed + off)
        if weight:
            common["weightCol"] = weight
        if kind == "rf":
            return RandomForestClassifier(numTrees=self.max_iter, **common, **p)
        return GBTClassifier(maxIter=self.max_iter, lossType="logistic", **common, **p)


def member(name: str, max_iter: int = 20, **override) -> Member:
    p = dict(PRESETS[name])
    p.update(override)
    return Member(name, p, max_iter)


def with_weight(df: DataFrame, spw: float, label: str = "target") -> DataFrame:
    """``weight = scale_pos_weight`` for positives, 1 otherwise; ``label`` as double."""
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0))) \
             .withColumn("label", F.col(label).cast("double"))


def assembler(features: list[str]) -> VectorAssembler:
    # Inputs are imputed; a NULL or NaN here is a bug upstream, so fail loudly.
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def positive_score(scored: DataFrame, out: str = "score") -> DataFrame:
    return scored.withColumn(out, vector_to_array(F.col("probability"))[1])


@dataclass
class CVResult:
    oof: DataFrame       # id, fold, target, model, score
    test: DataFrame      # id, model, score (mean over fold models)
    fold_test: DataFrame  # id, fold, model, score
    best_iters: dict[int, int] = field(default_factory=dict)


def best_iteration(model, valid: DataFrame) -> int:
    """1-based iteration with the lowest validation log-loss (``evaluateEachIteration``)."""
    losses = model.evaluateEachIteration(valid)
    return int(min(range(len(losses)), key=lambda i: (losses[i], i))) + 1


def prefix_model(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The boosted model of the first ``n`` trees of ``model``; equal to a fit that stops there."""
    spark = SparkSession.active()
    gateway = spark.sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    own, weights = model._java_obj.trees(), model.treeWeights
    n = max(1, min(n, len(weights)))
    trees, shares = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n), gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        trees[i], shares[i] = own[i], weights[i]
    java = ml.classification.GBTClassificationModel(f"{model.uid}_first_{n}", trees, shares)
    java.setFeaturesCol(model.getFeaturesCol())
    return GBTClassificationModel(java)


def fits_at_once(spark: SparkSession, rows: int, n_features: int) -> int:
    """Fits of ``rows`` rows that the executors' storage memory holds side by side (one at least).

    A fit keeps its binned rows and reads them at every level of every tree; fits that
    push each other's rows to disk read and write them again each time.
    """
    sc, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm
    held = dict(jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc.getExecutorMemoryStatus()))
    own = sc.env().blockManager().blockManagerId().hostPort()
    room = sum(v._1() for k, v in held.items() if k != own or len(held) == 1)
    return max(1, int(FIT_SHARE * room / (max(1, rows) * (4 * n_features + FIT_ROW_BYTES))))


def cross_val(train: DataFrame, test: DataFrame | None, features: list[str], m: Member, k: int, spw: float,
              synthetic: DataFrame | None = None, seed: int = 42, label: str = "target", fold_col: str = "fold",
              early_stop: bool = False, extra_train: DataFrame | None = None,
              parallelism: int | None = None, per_fold: dict[str, str] | None = None) -> CVResult:
    """Out-of-fold scores of ``m`` over ``k`` folds (optionally with SMOTE rows and extra rows).

    The ``k`` fits are independent Spark jobs; they are submitted from
    ``parallelism`` driver threads (default ``k``, or as many as
    :func:`fits_at_once` says) so the small per-iteration stages of one fit interleave
    with the others' instead of leaving executors idle.  ``per_fold`` names features
    that differ by validation fold: of ``{"te_x": "te_x__o{}"}`` the model of fold 2
    takes the column ``te_x__o2``.

    A partition of a fit sends a whole histogram (nodes x features x bins) for every
    level of every tree, so the fits join their partitions to one per core, or to
    ``FIT_ROWS`` training rows each where that makes more.
    """
    va = assembler(features)
    rows = train.count()
    width = max(train.sparkSession.sparkContext.defaultParallelism, -(-rows // FIT_ROWS))
    parallelism = parallelism or fits_at_once(train.sparkSession, rows, len(features))
    iters = {}

    def taken(f: int) -> list:
        return [F.col((per_fold or {}).get(c, c).format(f)).alias(c) for c in features]

    def side(df: DataFrame, f: int) -> DataFrame:
        return with_weight(df.select("id", fold_col, label, *taken(f)), spw, label)

    def fit_fold(f: int):
        fit_rows = side(train.filter(F.col(fold_col) != f), f).select("id", label, *features)
        if synthetic is not None:
            fit_rows = fit_rows.unionByName(
                synthetic.filter(F.col("tf") == f).select((-(F.col("syn_id") + 1)).alias("id"),
                                                          F.lit(1).alias(label), *taken(f)))
        if extra_train is not None:
            fit_rows = fit_rows.unionByName(extra_train.select("id", F.col(label).cast("int").alias(label), *taken(f)))
        fit_rows = va.transform(with_weight(fit_rows, spw, label))
        val = va.transform(side(train.filter(F.col(fold_col) == f), f))
        model = m.estimator(seed).fit(fit_rows.coalesce(width))
        if early_stop and isinstance(model, GBTClassificationModel):
            iters[f] = best_iteration(model, val)
            model = prefix_model(model, iters[f])
        return model, val

    with ThreadPoolExecutor(max_workers=max(1, min(k, parallelism))) as pool:
        fitted = list(pool.map(fit_fold, range(k)))
    oofs, tests = [], []
    for f, (model, val) in enumerate(fitted):
        oofs.append(positive_score(model.transform(val)).select(
            "id", F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("int").alias("target"),
            F.lit(m.name).alias("model"), "score"))
        if test is not None:
            tests.append(positive_score(model.transform(va.transform(test.select("id", *taken(f))))).select(
                "id", F.lit(f).alias("fold"), F.lit(m.name).alias("model"), "score"))
    oof = _union(oofs)
    fold_test = _union(tests) if tests else None
    mean = fold_test.groupBy("id", "model").agg(F.avg("score").alias("score")) if fold_test is not None else None
    return CVResult(oof, mean, fold_test, iters)


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def fold_metrics(oof: DataFrame) -> DataFrame:
    k = ["model", "fold"]
    return average_precision(oof, k).join(roc_auc(oof, k), k)


def logistic_newton(rows: DataFrame, cols: list[str], C: float = 1.0, label: str = "target", max_iter: int = 50, tol: float = 1e-12) -> list[float]:
    """Intercept and weights that minimise ``C * log-loss sum + |weights|^2 / 2``, by reweighted normal equations.

    Every Newton step is one aggregation: the (d + 1) x (d + 1) weighted sums and the
    gradient, whose size depends on the number of columns alone; the driver solves it.
    """
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in cols]]
    d = len(x)
    beta = np.zeros(d)
    penalty = np.diag([0.0] + [1.0 / C] * (d - 1))
    for _ in range(max_iter):
        margin = reduce(lambda a, b: a + b, [F.lit(float(w)) * v for w, v in zip(beta, x)])
        p = 1 / (1 + F.exp(-margin))
        w = p * (1 - p)
        cells = [(i, j) for i in range(d) for j in range(i, d)]
        row = rows.agg(*[F.sum(w * x[i] * x[j]) for i, j in cells], *[F.sum((F.col(label) - p) * v) for v in x]).first()
        if row[0] is None:
            return [0.0] * d
        h = np.zeros((d, d))
        for (i, j), v in zip(cells, row):
            h[i, j] = h[j, i] = v
        # rows of one class alone push the intercept to infinity: the steps are held then
        step = np.linalg.lstsq(h + penalty + 1e-12 * np.eye(d), np.array(row[len(cells):]) - penalty @ beta, rcond=None)[0]
        step *= min(1.0, 10.0 / max(1e-300, float(np.abs(step).max())))
        beta = beta + step
        if float(np.abs(step).max()) < tol:
            break
    return [float(b) for b in beta]


def meta_stack(oof_wide: DataFrame, test_wide: DataFrame, models: list[str], C: float = 1.0,
               label: str = "target") -> tuple[DataFrame, DataFrame]:
    """Logistic regression on z-scored member scores (population std), scored in-sample and on test."""
    from raretide.operators.impute import fit_standardiser
    st = fit_standardiser(oof_wide, models)
    tr = st.transform(oof_wide)
    beta = logistic_newton(tr, models, C, label)
    margin = reduce(lambda a, b: a + b, [F.lit(w) * F.col(m) for w, m in zip(beta[1:], models)], F.lit(beta[0]))
    score = (1 / (1 + F.exp(-margin))).alias("meta")
    return tr.select("id", label, score), st.transform(test_wide).select("id", score)


# Search ranges of the v4 hyper-parameter search (learning rate log-uniform
# 0.01-0.06, depth 6-12, min leaf 10-60, column and row fraction 0.5-0.9, min gain 0-0.1).
SEARCH_SPACE = {
    "stepSize": ("log", 0.01, 0.06),
    "maxDepth": ("int", 6, 12),
    "minInstancesPerNode": ("int", 10, 60),
    "featureSubsetStrategy": ("frac", 0.5, 0.9),
    "subsamplingRate": ("float", 0.5, 0.9),
    "minInfoGain": ("float", 0.0, 0.1),
}


def sample_params(n_trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded random search points (driver-side: n_trials small dicts)."""
    import math
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for name, (kind, lo, hi) in (space or SEARCH_SPACE).items():
            if kind == "log":
                p[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            elif kind == "int":
                p[name] = rng.randint(lo, hi)
            elif kind == "frac":
                p[name] = f"{rng.uniform(lo, hi):.3f}"
            else:
                p[name] = rng.uniform(lo, hi)
        out.append(p)
    return out


def rung_search(train: DataFrame, features: list[str], base: Member, k: int, spw: float, n_trials: int, seed: int = 42,
                parallelism: int = 2, synthetic: DataFrame | None = None, trees: int | None = None, keep: int = 3) -> tuple[DataFrame, dict]:
    """Every evaluation ``(trial, rung, trees, mean_ap, params)`` of a search, and the winner's parameters.

    Rung 0 fits all trials with few trees; of each rung the best 1 / ``keep`` go on with
    ``keep`` times as many, the last rung at ``trees`` (the member's own number by default).
    ``train`` holds the inner folds, ``synthetic`` their synthetic rows (one set per inner
    split), so no trial sees a row made from its validation fold.  Trials run as
    concurrent Spark jobs; ties go to the earlier trial.
    """
    spark = train.sparkSession
    trials = sample_params(n_trials, seed)
    parallelism = min(parallelism, fits_at_once(spark, train.count(), len(features)) // k)  # a trial makes k fits
    alive, rows, rung = list(range(n_trials)), [], 0
    top = trees or base.max_iter
    rungs = 0
    while n_trials > keep ** (rungs + 1):
        rungs += 1
    while True:
        size = max(1, top // keep ** (rungs - rung))

        def run(i: int) -> tuple[int, float]:
            m = Member(f"trial_{i}", {**base.params, **trials[i]}, size)
            cv = cross_val(train, None, features, m, k, spw, synthetic, seed, early_stop=True)
            ap = average_precision(cv.oof, ["fold"]).agg(F.avg("ap")).first()[0]
            return i, float(ap) if ap is not None else float("-inf")

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            done = sorted(pool.map(run, alive), key=lambda t: (-t[1], t[0]))
        rows += [(i, rung, size, ap if ap > float("-inf") else None, {n: str(v) for n, v in trials[i].items()}) for i, ap in done]
        if rung == rungs:
            break
        alive, rung = [i for i, _ in done[:max(1, -(-len(done) // keep))]], rung + 1
    table = spark.createDataFrame(rows, "trial int, rung int, trees int, mean_ap double, params map<string,string>")
    return table, trials[done[0][0]]


def random_search(train: DataFrame, features: list[str], base: Member, k: int, spw: float, n_trials: int,
                  seed: int = 42, parallelism: int = 2, synthetic: DataFrame | None = None) -> DataFrame:
    """The evaluations of :func:`rung_search`."""
    return rung_search(train, features, base, k, spw, n_trials, seed, parallelism, synthetic)[0]
