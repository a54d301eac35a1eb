"""Stratified, seeded k-fold assignment (balanced to within one row per class).

Fold of a row = (its 0-based position within its class, ordered by a seeded
hash of the id, then the id) modulo k.  Counts per fold and class therefore
differ by at most one, like a stratified shuffled splitter, and the
assignment is a pure function of (ids, labels, seed): re-running a lost
partition gives the same folds.

At scale a window per class has only two partitions (one holding ~96 % of the
rows).  The hash is uniform on [0, 2**32), so the class is cut into
``n_buckets`` hash ranges: positions = (rows of the class in lower ranges) +
(row number inside the range).  That equals the single-window numbering
exactly while the numbering runs in ``2 x n_buckets`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raretide.functions.hashing import MOD32, mult_hash32
from raretide.operators.ordered import default_buckets


def stratified_folds(df: DataFrame, k: int, seed: int = 42, label: str = "target", id_col: str = "id",
                     fold_col: str = "fold", n_buckets: int | None = None, keep_rank: bool = False) -> DataFrame:
    """Add ``fold`` (and with ``keep_rank`` the 0-based class position ``class_rank``)."""
    n_buckets = default_buckets(df.sparkSession) if n_buckets is None else n_buckets
    h = mult_hash32(id_col, seed)
    tagged = df.withColumn("__h", h).withColumn("__hb", F.floor(F.col("__h") * n_buckets / MOD32).cast("int"))
    sizes = tagged.groupBy(label, "__hb").agg(F.count(F.lit(1)).alias("__n"))
    wo = Window.partitionBy(label).orderBy("__hb").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(label, "__hb", F.coalesce(F.sum("__n").over(wo), F.lit(0)).alias("__off"))
    w = Window.partitionBy(label, "__hb").orderBy("__h", id_col)
    pos = F.col("__off") + F.row_number().over(w) - 1
    out = tagged.join(offs, [label, "__hb"], "left").withColumn("__pos", pos)
    cols = [F.col(c) for c in df.columns] + [F.pmod(F.col("__pos"), F.lit(k)).cast("int").alias(fold_col)]
    if keep_rank:
        cols.append(F.col("__pos").alias("class_rank"))
    return out.select(*cols)


def fold_sizes(folded: DataFrame, label: str = "target", fold_col: str = "fold") -> DataFrame:
    """Rows per (fold, class) on the training side of each split and its validation side."""
    per = folded.groupBy(fold_col, label).agg(F.count(F.lit(1)).alias("n_val"))
    tot = folded.groupBy(label).agg(F.count(F.lit(1)).alias("n_all"))
    return per.join(tot, label).select(
        fold_col, label, F.col("n_val").cast("long").alias("n_val"),
        (F.col("n_all") - F.col("n_val")).cast("long").alias("n_train"))
