"""Benchmark the headline steps of the scoring plan.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every step is forced to
completion with the ``noop`` sink (full computation, nothing collected) or a
stage write, in a fresh stage folder, so no cached result is reused.

Steps mirror the reference's published budget: features + encoding +
imputation, oversampling, each ensemble member (5-fold CV + SMOTE), and
blend + rank normalisation + write; plus the analytic operators on their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from raretide.operators import blend, folds, learners, metrics, ranknorm  # noqa: E402
from raretide.plans import catalog, fixture, pipeline  # noqa: E402
from raretide.session import checkpoint_root, local_session  # noqa: E402
from raretide.sources.sink import write_submission  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="raretide-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # The session's checkpoint folder (a fresh per-application sub-folder of
    # spark.checkpoint.dir, or of a scratch folder only when that is unset).
    scratch = checkpoint_root(spark)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    cfg = pipeline.PlanConfig(members=[learners.member("lgb", 20), learners.member("xgb", 20),
                                       learners.member("rf", 40)])
    # 1. features + out-of-fold target encoding + imputation (written as a stage)
    tr, ts, feats, spw, key = timed("features_encode_impute", lambda: pipeline.features_stage(spark, sf_dir, cfg))
    # 2. exact SMOTE neighbours + synthetic rows per training split
    syn = timed("smote", lambda: pipeline.smote_stage(spark, tr, feats, cfg, key))
    # 3. ensemble members, 5-fold CV each with the split's synthetic rows
    parts = []
    for m in cfg.members:
        parts.append(timed(f"member_{m.name}", lambda m=m: pipeline.member_stage(
            spark, tr, ts, feats, m, cfg, spw, syn, key)))
    names = [m.name for m in cfg.members]

    # 4. blend grid + rank normalisation + parallel CSV write
    def tail():
        oof = learners._union([p[0] for p in parts])
        tst = learners._union([p[1] for p in parts])
        ow = blend.pivot_scores(oof, names, ["id", "target"])
        tw = blend.pivot_scores(tst, names, ["id"])
        best = blend.search(ow, names, cfg.blend_steps, "ap").first()
        w = [best[n] / cfg.blend_steps for n in blend.weight_names(len(names))]
        ob = blend.apply_weights(ow, names, w, "score").withColumn("__k", F.lit(0))
        tb = blend.apply_weights(tw, names, w, "score").withColumn("__k", F.lit(0))
        knots = ranknorm.rank_knots(ob, ["__k"])
        final = ranknorm.interpolate(knots, tb.select("id", "score", "__k"), ["__k"], out="final")
        write_submission(final.select("id", F.col("final").alias("score")), f"{scratch}/submission")
    timed("blend_rank_write", tail)

    # Analytic operators on the whole fixture tables.
    timed("op_fixture_base_write", lambda: fixture.base_table(spark, sf_dir))
    timed("op_engineer", lambda: noop(catalog.q_engineer_v4(spark, sf_dir)))
    timed("op_te_oof", lambda: noop(catalog.q_te_oof(spark, sf_dir)))
    timed("op_folds", lambda: noop(folds.stratified_folds(fixture.split(spark, sf_dir)[0], fixture.K_FOLDS, fixture.SEED)))
    timed("op_metrics", lambda: noop(metrics.metric_by_fold(fixture.oof_long(spark, sf_dir), ["model"])))
    timed("op_blend3_exact", lambda: noop(catalog.q_blend3_ap(spark, sf_dir)))
    timed("op_blend4_search", lambda: blend.search(fixture.oof_wide(spark, sf_dir), fixture.MODELS, 20, "ap").collect())
    timed("op_rank_norm_test", lambda: noop(catalog.q_rank_norm_test(spark, sf_dir)))
    timed("op_smote_knn", lambda: noop(catalog.q_smote_knn(spark, sf_dir)))

    plan = sum(v for k, v in times.items() if not k.startswith("op_"))
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "scoring_plan_wall", "value": round(plan, 3), "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
