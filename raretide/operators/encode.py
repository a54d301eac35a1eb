"""Out-of-fold target encoding of quantile bins.

fit:
  * bin edges: 21 exact quantiles (0, 0.05, ..., 1) of each column over
    train and test together, de-duplicated, outer edges opened to +-inf;
    all columns in one distributed pass (:mod:`quantiles`);
  * statistics: ONE ``groupBy(col, fold, bin)`` over the unpivoted train rows
    for all columns and folds; the out-of-fold sums are the per-(col, bin)
    totals minus the fold's own (a window over the tiny stats table), so no
    per-fold pass is needed;
  * smoothed rate ``(sum + m * g) / (count + m)`` with ``g`` the train mean.

The fitted model holds at most ``cols x (folds + 1) x n_bins`` numbers - a
size fixed by the parameters, not by the data - so ``transform`` is a pure
projection: bin expression plus a literal array lookup per column.  No join and
no shuffle is needed to apply it, on train or test.

Bins are right-closed ``(a, b]`` and numbered from 0 like ``pandas.cut``;
a NULL value, an unseen bin, or a column with fewer than two distinct edges
encodes to ``g``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raretide.operators.quantiles import column_quantiles

#: What a task of the nested encoder's counting says.
COUNTS = pa.schema({"outer": pa.int32(), "col": pa.string(), "bin": pa.int32(), "fold": pa.int32(), "n": pa.int64(), "s": pa.int64()})


def edge_probs(n_bins: int) -> list[float]:
    return [i / n_bins for i in range(n_bins + 1)]


def quantile_edges(train: DataFrame, test: DataFrame | None, cols: list[str], n_bins: int = 20,
                   exact: bool = True) -> DataFrame:
    """``col, q_idx, edge``: the raw quantile edges of train (union test)."""
    both = train.select(*cols)
    if test is not None:
        both = both.unionByName(test.select(*cols))
    return column_quantiles(both, cols, edge_probs(n_bins), exact=exact).select(
        "col", "q_idx", F.col("quantile").alias("edge"))


def inner_edges(edge_list: list[float]) -> list[float] | None:
    """Unique edges with the two ends dropped (they become -inf/+inf).

    ``None`` when fewer than two distinct edges exist: no bin can be formed.
    """
    uniq: list[float] = []
    for e in edge_list:
        if not uniq or e != uniq[-1]:
            uniq.append(e)
    if len(uniq) < 2:
        return None
    return uniq[1:-1]


def bin_expr(x: Column, inner: list[float] | None) -> Column:
    """Right-closed bin ordinal: number of inner edges strictly below ``x``."""
    if inner is None:
        return F.lit(None).cast("int")
    if not inner:
        return F.when(x.isNotNull(), F.lit(0))
    total = None
    for e in inner:
        t = (x > F.lit(float(e))).cast("int")
        total = t if total is None else total + t
    return F.when(x.isNotNull(), total)


@dataclass
class TargetEncoderModel:
    cols: list[str]
    prior: float
    inner: dict[str, list[float] | None]
    oof: dict[str, dict[tuple[int, int], float]] = field(default_factory=dict)
    full: dict[str, dict[int, float]] = field(default_factory=dict)
    fold_col: str = "fold"
    prefix: str = "te_"

    def bins(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[bin_expr(F.col(c), self.inner[c]).alias(f"bin_{c}") for c in self.cols])

    def _lookup(self, table: dict, key: Column) -> Column:
        if not table:
            return F.lit(self.prior)
        # A literal array by position: the cost of a cell does not follow folds x bins.
        cells = F.array(*[F.lit(float(table[k]) if k in table else None).cast("double") for k in range(max(table) + 1)])
        return F.coalesce(F.get(cells, key.cast("int")), F.lit(self.prior))

    def transform_oof(self, train: DataFrame) -> DataFrame:
        """Train rows: each row encoded with statistics of the other folds."""
        out = []
        for c in self.cols:
            b = bin_expr(F.col(c), self.inner[c])
            rates = self.oof.get(c, {})
            width = 1 + max((bi for _, bi in rates), default=0)
            flat = {f * width + bi: v for (f, bi), v in rates.items()}
            # A bin that no other fold has lies beyond the width and takes the prior.
            key = F.when(b < width, F.col(self.fold_col).cast("long") * width + b)
            out.append(F.when(b.isNull(), F.lit(self.prior)).otherwise(self._lookup(flat, key)).alias(self.prefix + c))
        return train.select("*", *out)

    def full_columns(self) -> list[Column]:
        """The encodings by the statistics of the whole training table, one per column."""
        out = []
        for c in self.cols:
            b = bin_expr(F.col(c), self.inner[c])
            out.append(F.when(b.isNull(), F.lit(self.prior))
                       .otherwise(self._lookup(self.full.get(c, {}), b.cast("long"))).alias(self.prefix + c))
        return out

    def transform_test(self, test: DataFrame) -> DataFrame:
        """Test rows: statistics of the whole training table."""
        return test.select("*", *self.full_columns())


def fold_stats(binned: DataFrame, cols: list[str], prior: float, smooth: float, label: str = "target",
               fold_col: str = "fold") -> DataFrame:
    """``col, fold, bin, n_other, s_other, enc`` for every (col, fold, bin) seen in train."""
    long = binned.select(fold_col, label, *[F.col(f"bin_{c}").alias(c) for c in cols]) \
        .unpivot([fold_col, label], cols, "col", "bin").filter(F.col("bin").isNotNull())
    st = long.groupBy("col", fold_col, "bin").agg(
        F.count(F.lit(1)).alias("n_fold"), F.sum(F.col(label).cast("long")).alias("s_fold"))
    w = Window.partitionBy("col", "bin")
    st = st.select("col", F.col(fold_col).alias("fold"), F.col("bin").cast("int").alias("bin"), "n_fold", "s_fold",
                   (F.sum("n_fold").over(w) - F.col("n_fold")).alias("n_other"),
                   (F.sum("s_fold").over(w) - F.col("s_fold")).alias("s_other"))
    return st.withColumn("enc", (F.col("s_other") + smooth * prior) / (F.col("n_other") + smooth))


def full_stats(binned: DataFrame, cols: list[str], prior: float, smooth: float,
               label: str = "target") -> DataFrame:
    long = binned.select(label, *[F.col(f"bin_{c}").alias(c) for c in cols]) \
        .unpivot([label], cols, "col", "bin").filter(F.col("bin").isNotNull())
    st = long.groupBy("col", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("s"))
    return st.select("col", F.col("bin").cast("int").alias("bin"), "n", "s",
                     ((F.col("s") + smooth * prior) / (F.col("n") + smooth)).alias("enc"))


class TargetEncoder:
    """``TargetEncoder(cols).fit(train, test)`` -> :class:`TargetEncoderModel`.

    ``train`` must carry the encoder's fold column (see :mod:`folds`).
    """

    def __init__(self, cols: list[str], smooth: float = 30.0, n_bins: int = 20, label: str = "target",
                 fold_col: str = "fold", exact: bool = True, prefix: str = "te_"):
        self.cols, self.smooth, self.n_bins = list(cols), float(smooth), n_bins
        self.label, self.fold_col, self.exact, self.prefix = label, fold_col, exact, prefix

    def fit(self, train: DataFrame, test: DataFrame | None = None) -> TargetEncoderModel:
        cols = [c for c in self.cols if c in train.columns]
        prior = float(train.agg(F.avg(F.col(self.label).cast("double"))).first()[0])
        # Bounded: len(cols) x (n_bins + 1) edges.
        rows = quantile_edges(train, test, cols, self.n_bins, self.exact).collect()
        edges: dict[str, list[tuple[int, float]]] = {c: [] for c in cols}
        for r in rows:
            edges[r["col"]].append((r["q_idx"], r["edge"]))
        inner = {c: inner_edges([e for _, e in sorted(edges[c])]) for c in cols}
        model = TargetEncoderModel(cols, prior, inner, fold_col=self.fold_col, prefix=self.prefix)
        binned = model.bins(train)
        # Bounded: len(cols) x folds x n_bins rows.  The whole-train statistics
        # are the sums over folds, so they need no second pass.
        totals: dict[tuple[str, int], list[int]] = {}
        for r in fold_stats(binned, cols, prior, self.smooth, self.label, self.fold_col).collect():
            model.oof.setdefault(r["col"], {})[(r["fold"], r["bin"])] = r["enc"]
            t = totals.setdefault((r["col"], r["bin"]), [0, 0])
            t[0] += int(r["n_fold"])
            t[1] += int(r["s_fold"])
        for (c, b), (n, s_) in totals.items():
            model.full.setdefault(c, {})[b] = (s_ + self.smooth * prior) / (n + self.smooth)
        return model


class NestedTargetEncoder:
    """Encodings that a model trained outside fold ``o`` may use, for every ``o`` (leak-safe cross-validation).

    For the outer fold ``o`` nothing is learnt from its labels or values: the bin edges
    are quantiles of the rows outside it (and the test rows), the prior is their mean.  A
    training row of fold ``i`` takes the rate of the rows outside ``o`` and ``i``, a row of
    fold ``o`` and a test row that of all rows outside ``o``.  One aggregate counts
    (outer, column, bin, fold); every rate is a total less a part of it.
    """

    def __init__(self, cols: list[str], k: int, smooth: float = 30.0, n_bins: int = 20, label: str = "target",
                 fold_col: str = "fold", exact: bool = True, prefix: str = "te_"):
        self.cols, self.k, self.smooth, self.n_bins = list(cols), k, float(smooth), n_bins
        self.label, self.fold_col, self.exact, self.prefix = label, fold_col, exact, prefix

    def fit(self, train: DataFrame, test: DataFrame | None = None) -> NestedTargetEncoderModel:
        cols = [c for c in self.cols if c in train.columns]
        outers = range(self.k)
        y, fold = F.col(self.label).cast("double"), F.col(self.fold_col)
        row = train.agg(*[F.avg(F.when(fold != o, y)) for o in outers]).first()
        priors = [float(v) if v is not None else 0.0 for v in row]

        # the columns of every outer fold side by side: one set of passes serves them all
        own = {f"{c}__{o}": (o, c) for o in outers for c in cols}
        outside = train.select(*[F.when(fold.isNotNull() & (fold != o), F.col(c)).alias(name) for name, (o, c) in own.items()])
        probes = None if test is None else test.select(*[F.col(c).alias(name) for name, (_, c) in own.items()])
        rows = quantile_edges(outside, probes, list(own), self.n_bins, self.exact).collect()
        inner: list[dict[str, list[float] | None]] = [{} for _ in outers]
        for name, (o, c) in own.items():
            inner[o][c] = inner_edges([r["edge"] for r in sorted((r for r in rows if r["col"] == name), key=lambda r: r["q_idx"])])
        edges = [(o, c, np.array(inner[o][c])) for o in outers for c in cols if inner[o][c] is not None]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple, np.ndarray] = {}  # (outer, column, fold): rows and labels of every bin
            for batch in batches:
                seen, at = np.unique(batch.column("__fold").to_numpy(zero_copy_only=False), return_inverse=True)
                y = batch.column("__y").fill_null(0).to_numpy()
                for o, c, inside in edges:
                    use = batch.column(c).is_valid().to_numpy(zero_copy_only=False) & (seen != o)[at]
                    width = len(inside) + 1
                    x = batch.column(c).to_numpy(zero_copy_only=False)[use]
                    cell = at[use] * width + np.searchsorted(inside, x, "left")  # the edges below a value; NaN lies above all
                    got = np.stack([np.bincount(cell, v, len(seen) * width) for v in (None, y[use])]).astype(np.int64)
                    for i, f in enumerate(seen.tolist()):
                        sums[o, c, f] = sums.get((o, c, f), 0) + got[:, i * width:(i + 1) * width]
            out = [(o, c, b, f, int(n), int(t)) for (o, c, f), (ns, ts) in sums.items() for b, (n, t) in enumerate(zip(ns, ts)) if n]
            yield pa.RecordBatch.from_pylist([dict(zip(COUNTS.names, row)) for row in out], COUNTS)

        narrow = train.where(fold.isNotNull()).select(fold.cast("int").alias("__fold"), F.col(self.label).cast("long").alias("__y"), *[F.col(c).cast("double").alias(c) for c in cols])
        # outers x columns x bins x folds rows
        counts = narrow.mapInArrow(count, "outer int, col string, bin int, fold int, n long, s long") \
            .groupBy("outer", "col", "bin", "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
        totals: dict[tuple[int, str, int], list[int]] = {}
        for r in counts:
            t = totals.setdefault((r["outer"], r["col"], r["bin"]), [0, 0])
            t[0] += int(r["n"])
            t[1] += int(r["s"])
        models = [TargetEncoderModel(cols, priors[o], inner[o], fold_col=self.fold_col, prefix=self.prefix) for o in outers]
        rate = lambda o, n, s: (s + self.smooth * priors[o]) / (n + self.smooth)
        for (o, c, b), (n, s) in totals.items():
            models[o].full.setdefault(c, {})[b] = rate(o, n, s)
        for r in counts:
            n, s = totals[r["outer"], r["col"], r["bin"]]
            models[r["outer"]].oof.setdefault(r["col"], {})[r["fold"], r["bin"]] = rate(r["outer"], n - int(r["n"]), s - int(r["s"]))
        return NestedTargetEncoderModel(models, self.fold_col)


@dataclass
class NestedTargetEncoderModel:
    models: list[TargetEncoderModel]
    fold_col: str = "fold"

    def names(self, outer: int) -> dict[str, str]:
        """The encoded columns' names in a table that holds those of all outer folds."""
        m = self.models[outer]
        return {m.prefix + c: f"{m.prefix}{c}__o{outer}" for c in m.cols}

    def transform_train(self, train: DataFrame, outer: int) -> DataFrame:
        """``train`` with the encodings of the model that is validated on fold ``outer``."""
        m = self.models[outer]
        inside = m.transform_oof(train)
        full = {m.prefix + c: e for c, e in zip(m.cols, m.full_columns())}
        return inside.select(*[F.when(F.col(self.fold_col) == outer, full[c]).otherwise(F.col(c)).alias(c) if c in full else F.col(c) for c in inside.columns])

    def transform_test(self, test: DataFrame, outer: int) -> DataFrame:
        return self.models[outer].transform_test(test)

    def transform_all(self, df: DataFrame, train: bool) -> DataFrame:
        """``df`` with the encodings for every outer fold, named by :meth:`names`."""
        out = df
        for o in range(len(self.models)):
            done = self.transform_train(out, o) if train else self.transform_test(out, o)
            out = done.withColumnsRenamed(self.names(o))
        return out
