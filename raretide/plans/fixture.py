"""Shared inputs of the registered queries: the fixture entity table, folds and
stand-in model scores (FIXTURES.md section 3).

Score-dependent operators must be checkable without a trained model, so four
deterministic columns of the entity table stand in for four models.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.operators.folds import stratified_folds
from raretide.sources.entities import FEATURES, is_test, train_test
from raretide.sources.stages import fingerprint, input_key, stage

K_FOLDS = 5
SEED = 42
MODELS = ["m1", "m2", "m3", "m4"]


def standin_scores() -> dict[str, Column]:
    return {
        "m1": F.col("feature_1") / 500000.0,
        "m2": F.col("feature_12") / 5.0,
        "m3": F.coalesce(F.col("feature_4"), F.lit(0.0)) / 500.0,
        "m4": F.coalesce(F.col("feature_6"), F.lit(0.0)) * 10.0,
    }


def r6(c: Column | str) -> Column:
    """Round a computed double to 6 decimals (+0.0 turns -0.0 into 0.0).

    Spelled as ``floor(x * 1e6 + 0.5) / 1e6`` (sign-aware) so that any
    engine doing the same IEEE operations gets the same bits, half-way cases
    included.  From 1e9 up the scaled value leaves the exact-integer range of
    a double, so such magnitudes are kept as they are.
    """
    x = F.col(c) if isinstance(c, str) else c
    up = F.floor(x * 1000000.0 + 0.5).cast("double") / 1000000.0
    down = F.ceil(x * 1000000.0 - 0.5).cast("double") / 1000000.0
    return F.when(F.abs(x) >= 1e9, x).when(x < 0, down).otherwise(up) + F.lit(0.0)


def inputs_key(spark: SparkSession, sf_dir: str) -> str:
    """Fingerprint of the files that the entity view reads."""
    return input_key(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("orders", "customer", "lineitem")])


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity rows with ``fold`` (train side, k=5) written once as a stage.

    Every query below reads this table instead of re-running the joins in
    each branch of its plan; the stage is keyed by the input files.
    """
    def build() -> DataFrame:
        train, test = train_test(spark, sf_dir)
        f = stratified_folds(train, K_FOLDS, SEED)
        return f.unionByName(test, allowMissingColumns=True)
    return stage(spark, "fixture_base", fingerprint(inputs_key(spark, sf_dir), K_FOLDS, SEED), build)


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = base_table(spark, sf_dir)
    tr = b.filter(~is_test()).drop("fold")
    te = b.filter(is_test()).drop("fold", "target")
    return tr, te


def folded_train(spark: SparkSession, sf_dir: str, k: int = K_FOLDS) -> DataFrame:
    if k == K_FOLDS:
        return base_table(spark, sf_dir).filter(~is_test())
    train, _ = split(spark, sf_dir)
    return stratified_folds(train, k, SEED)


def oof_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows with fold and one column per stand-in model."""
    f = folded_train(spark, sf_dir)
    s = standin_scores()
    return f.select("id", "fold", "target", *[s[m].alias(m) for m in MODELS])


def test_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = split(spark, sf_dir)
    s = standin_scores()
    return test.select("id", *[s[m].alias(m) for m in MODELS])


def oof_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``oof_scores``: id, fold, target, model, score."""
    w = oof_wide(spark, sf_dir)
    return w.unpivot(["id", "fold", "target"], MODELS, "model", "score")


def test_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``test_scores``: id, model, score."""
    return test_wide(spark, sf_dir).unpivot(["id"], MODELS, "model", "score")


__all__ = ["FEATURES", "K_FOLDS", "MODELS", "SEED", "folded_train", "oof_long", "oof_wide", "r6", "split",
           "standin_scores", "test_long", "test_wide"]
