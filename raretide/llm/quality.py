"""Quality classifier by Bradley-Terry pairwise ranking.

Each labelled good document is preferred to a number of labelled bad ones.
The probability that a is preferred to b is sigmoid(w . (x_a - x_b)), so ``w``
is the logistic fit, without intercept, on feature differences; a document's
strength is w . x.  The threshold is the quantile of the labelled strengths at
the share of bad labels; the score is a sigmoid of the strength shifted so that
this quantile gets ``CUT``.

Features are counted over the whole text in Arrow batches; they are written
once, and training, threshold and scores read that narrow table.  The fit uses
at most ``max_labelled`` rows of either label (those with the smallest MD5 of
their id) and ``partners`` opponents each: both are parameters.

Defined cases: a null text counts as empty and an empty text is scored as a
text of no words; a null ``doc_id`` is never trained on and is not held out;
repeated label rows count once (the larger quality holds); repeated documents
are scored each; when a label has no training row every score is ``CUT`` for
want of a preference; an empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log, log1p
from operator import eq

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

CUT = 0.3
FOLDS = 5
MAX_LABELLED = 5000
PARTNERS = 8
FEATURES = ["upper", "symbol", "bang", "digit", "same_word", "same_pair", "same_line", "word_len", "long_word", "length", "no_words"]
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#$%&*@^~|<>{}[]\\=+_`"]] = True


def text_features(text: str | None) -> list[float]:
    """Shares between 0 and 1 that describe one whole text (a helper of :func:`features`)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    upper, lower = seen[65:91].sum(), seen[97:123].sum()
    shown = max(1, len(raw) - int(seen[9:14].sum() + seen[32]))
    lines = Counter(x for x in raw.split(b"\n") if x.strip())
    twice = sum((k - 1) * len(x) for x, k in lines.items())
    pairs = max(1, n - 1)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    return [
        float(upper / max(1, upper + lower)), float(min(1.0, 4 * seen[_SYMBOLS].sum() / shown)), float(min(1.0, 8 * seen[33] / shown)),
        float(min(1.0, 4 * seen[48:58].sum() / shown)), sum(map(eq, words, words[1:])) / pairs,
        1 - len(set(zip(words, words[1:]))) / pairs if n > 1 else 0.0, twice / len(raw),
        min(1.0, float(sizes.mean()) / 20), float((sizes > 25).mean()), min(1.0, log1p(n) / 12), 0.0,
    ]


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs(text, ...)`` and ``x``, the feature array, for every row."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[keep].copy()
            out["x"] = [text_features(t) for t in b["text"]]
            yield out

    return docs.select(*keep, "text").mapInPandas(run, f"{kinds}, x array<double>")


def preference_pairs(labelled: DataFrame, max_labelled: int = MAX_LABELLED, partners: int = PARTNERS) -> DataFrame:
    """``(a, b)`` feature arrays, a preferred to b, from ``labelled(doc_id, quality, x)``.

    The bounded rows of each label are numbered in MD5 order; row i meets the
    opponents i * partners + 0, 1, ... (modulo their number): an equi-join, each
    row in ``partners`` pairs at least, no pair of all with all.
    """
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))

    def side(label: int) -> DataFrame:
        rows = labelled.where(F.col("quality") == label).orderBy(order, "doc_id").limit(max_labelled)
        number = Window.orderBy(order, "doc_id")
        return rows.select("x", (F.row_number().over(number) - 1).alias("i"))

    good, bad = stored(side(1), "bt-good"), stored(side(0), "bt-bad")
    n_good, n_bad = good.count(), bad.count()
    most, few = (good, bad) if n_good >= n_bad else (bad, good)
    n = max(1, min(n_good, n_bad))
    step = F.explode(F.sequence(F.lit(0), F.lit(partners - 1)))
    met = most.withColumn("s", step).select(F.col("x").alias("m"), F.pmod(F.col("i") * partners + F.col("s"), F.lit(n)).alias("i"))
    both = met.join(few.select("i", F.col("x").alias("f")), "i")
    return both.select(F.col("m" if n_good >= n_bad else "f").alias("a"), F.col("f" if n_good >= n_bad else "m").alias("b"))


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED, partners: int = PARTNERS) -> tuple[list[float], float] | None:
    """Weights and the strength at the score quantile; None when a label has no row."""
    labelled = stored(labelled, "bt-labelled")
    pairs = preference_pairs(labelled, max_labelled, partners)
    won = pairs.select(F.zip_with("a", "b", lambda p, q: p - q).alias("d"), F.lit(1.0).alias("y"))
    lost = pairs.select(F.zip_with("b", "a", lambda p, q: p - q).alias("d"), F.lit(0.0).alias("y"))
    rows = stored(won.unionByName(lost), "bt-pairs")
    if rows.isEmpty():
        return None
    model = LogisticRegression(featuresCol="v", labelCol="y", fitIntercept=False, regParam=1e-3, maxIter=60).fit(rows.select(array_to_vector("d").alias("v"), "y"))
    weights = [float(w) for w in model.coefficients]
    share = labelled.agg(F.avg(1.0 - F.col("quality"))).first()[0]
    strengths = labelled.select(strength(weights).alias("s"))
    low, high = strengths.agg(F.percentile_approx("s", [float(share), min(1.0, float(share) + 0.005)], 20000)).first()[0]
    return weights, (low + high) / 2


def strength(weights: list[float], x: Column | None = None) -> Column:
    """w . x of the feature array ``x`` (the column of that name, if none is given)."""
    x = F.col("x") if x is None else x
    return F.aggregate(F.zip_with(x, F.array(*map(F.lit, weights)), lambda a, w: a * w), F.lit(0.0), lambda t, y: t + y)


def scored(docs: DataFrame, labels: DataFrame, cut: float = CUT, folds: int = FOLDS, max_labelled: int = MAX_LABELLED,
           partners: int = PARTNERS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))
    rows = stored(features(docs.select("doc_id", "text"), ["doc_id"]).withColumn("held_out", held), "quality-x")
    named = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    train = rows.where(~F.col("held_out")).join(named, "doc_id").select("doc_id", "quality", "x")
    found = fit(train, max_labelled, partners)
    if found is None:
        score = F.lit(cut)
    else:
        weights, level = found
        score = 1 / (1 + F.exp(F.lit(level) - strength(weights) + F.lit(log((1 - cut) / cut))))
    out = rows.withColumn("score", score)
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= cut, 1).otherwise(0).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that are predicted 1; every row is judged by its own text, in place (no join back)."""
    rows = features(docs.select("doc_id", "text"), ["doc_id"])
    named = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    found = fit(rows.join(named, "doc_id").select("doc_id", "quality", "x"), **params)
    if found is None:
        return docs
    weights, level = found

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t) for t in texts])

    return docs.where(strength(weights, described("text")) >= F.lit(level))


def op10_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
