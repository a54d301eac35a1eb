"""Ranking metrics as aggregations over distinct scores.

Both metrics only need, per distinct score, the number of positives and rows,
and running sums of those in score order.  The scores are first combined to
``(keys, score) -> (pos, n)`` with map-side partial aggregation (a heavy tie
collapses to one row before any shuffle), then ordered with
:func:`ordered.prefix_sums`, which never plans a single-partition window.

* average precision: ``sum_i pos_i / P * TP_i / N_i`` over distinct scores in
  descending order (ties form one threshold), as ``average_precision_score``;
* ROC-AUC: ``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)`` (ties count
  one half), as ``roc_auc_score``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raretide.operators.ordered import default_buckets, prefix_sums


def score_counts(df: DataFrame, keys: list[str], score: str = "score", label: str = "target") -> DataFrame:
    return df.groupBy(*keys, score).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.count(F.lit(1)).alias("n"))


def average_precision(df: DataFrame, keys: list[str], score: str = "score", label: str = "target",
                      n_buckets: int | None = None, alias: str = "ap", n_keys: int | None = None,
                      many_ties: bool = False) -> DataFrame:
    """``many_ties``: scores take few distinct values (e.g. quantised), so
    combining rows per score first shrinks the data before the ordering."""
    nb = default_buckets(df.sparkSession, n_keys) if n_buckets is None else n_buckets
    if nb <= 1 and keys and not many_ties:
        # Keys alone fill the shuffle width: one window over the rows.  A RANGE
        # frame gives tied scores one shared running count, so each positive
        # row adds the precision of its threshold (= pos_s * P_s summed).
        w = Window.partitionBy(*keys).orderBy(F.col(score).desc()).rangeBetween(Window.unboundedPreceding, 0)
        y = F.col(label).cast("long")
        run = df.select(*keys, y.alias("__y"), F.sum(y).over(w).alias("__cp"), F.count(F.lit(1)).over(w).alias("__cn"))
        return run.groupBy(*keys).agg(
            F.try_divide(F.sum(F.when(F.col("__y") == 1, F.col("__cp") / F.col("__cn"))),
                         F.sum("__y").cast("double")).alias(alias))
    return ap_from_counts(score_counts(df, keys, score, label), keys, score, n_buckets, alias)


def ap_from_counts(sc: DataFrame, keys: list[str], score: str = "score", n_buckets: int | None = None,
                   alias: str = "ap") -> DataFrame:
    """Average precision from ``(keys, score) -> pos, n`` rows (one per distinct score)."""
    run = prefix_sums(sc, keys, [score], ["pos", "n"], descending=True, n_buckets=n_buckets)
    term = F.col("pos") * (F.col("cum_pos") / F.col("cum_n"))
    return run.groupBy(*keys).agg(
        F.try_divide(F.sum(term), F.first("tot_pos").cast("double")).alias(alias))


def roc_auc(df: DataFrame, keys: list[str], score: str = "score", label: str = "target",
            n_buckets: int | None = None, alias: str = "auc") -> DataFrame:
    return auc_from_counts(score_counts(df, keys, score, label), keys, score, n_buckets, alias)


def auc_from_counts(sc: DataFrame, keys: list[str], score: str = "score", n_buckets: int | None = None,
                    alias: str = "auc") -> DataFrame:
    """ROC-AUC from ``(keys, score) -> pos, n`` rows (one per distinct score)."""
    sc = sc.withColumn("neg", F.col("n") - F.col("pos"))
    run = prefix_sums(sc, keys, [score], ["neg", "pos"], n_buckets=n_buckets)
    term = F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.col("neg") / 2.0)
    agg = run.groupBy(*keys).agg(F.sum(term).alias("__t"), F.first("tot_pos").alias("__p"),
                                 F.first("tot_neg").alias("__n"))
    return agg.select(*keys, F.try_divide(F.col("__t"), (F.col("__p") * F.col("__n")).cast("double")).alias(alias))


def metric_by_fold(df: DataFrame, keys: list[str], fold_col: str = "fold", score: str = "score",
                   label: str = "target", n_buckets: int | None = None) -> DataFrame:
    """AP and AUC per (keys, fold)."""
    k = keys + [fold_col]
    return average_precision(df, k, score, label, n_buckets).join(roc_auc(df, k, score, label, n_buckets), k)
