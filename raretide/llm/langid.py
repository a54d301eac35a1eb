"""Language ID by error-correcting output codes.

Every learned language gets a binary codeword.  One binary classifier per code
bit, linear in the text's letter n-gram shares (1 to 3 letters, hashed), tells
the languages whose bit is 1 from the others.  Decoding weighs each bit by how
well its classifier did in training and picks the codeword of least weighted
logistic loss; a small gap to the runner-up flags the text as ambiguous.

With few languages the code is exhaustive (all splits of the languages); with
more it is a seeded code of the same length that maximises the least distance
between codewords.  Training takes at most ``max_labelled`` rows of the
training side (smallest MD5 of the id, per language), whole texts; n-gram counts
are summed in the tasks, so what reaches the driver is one row of ``DIMS``
counts per language and batch sum.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
null labels are not learned; a null ``doc_id`` is neither trained on nor held
out; with one learned language it is the answer for every text with letters,
with none ``und``; an empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

DIMS = 1 << 13
MAX_LABELLED = 4000
FOLDS = 4
HELD = 2
GAP = 0.1
SEED = 5
#: Languages up to which the code is exhaustive.
EXHAUSTIVE = 5
_OTHER = re.compile(r"[\W\d_]+")


def gram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of letter 1- to 3-grams of one whole text; None without letters."""
    plain = _OTHER.sub(" ", (text or "").lower())
    if not plain.strip() or not any(map(str.isalpha, plain)):
        return None
    c = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out = np.zeros(DIMS)
    code = np.zeros(len(c), dtype=np.uint64)
    for n in (1, 2, 3):
        code = code[:len(c) - n + 1] * np.uint64(0x110000) + c[n - 1:]
        slot = ((code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)
        keep = code != np.uint64(32) if n == 1 else slice(None)
        out += np.bincount(slot[keep].astype(np.int64), minlength=DIMS) / n
    return out


def code_matrix(n: int, seed: int = SEED) -> np.ndarray:
    """``n`` codewords of +1/-1 bits, as rows."""
    if n <= EXHAUSTIVE:
        bits = [[1 if i == 0 or j >> (i - 1) & 1 else -1 for i in range(n)] for j in range(2 ** (n - 1) - 1)]
        return np.array(bits or [[1] * n]).T
    length, rnd, best = 15 * int(np.ceil(np.log2(n))), np.random.default_rng(seed), (-1, None)
    for _ in range(200):
        code = rnd.choice([-1, 1], size=(n, length))
        code[:, np.abs(code.sum(0)) == n] *= np.where(np.arange(n) % 2, -1, 1)[:, None]
        least = min(int((a != b).sum()) for a, b in combinations(code, 2))
        best = max(best, (least, code), key=lambda x: x[0])
    return best[1]


def fit(train: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(languages, code, weights, offsets, bit weights) from ``train(doc_id, text, lang)``; None without a label."""
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    langs = sorted(r.lang for r in train.select("lang").distinct().toLocalIterator())
    if not langs:
        return None
    drawn = None
    for lang in langs:  # a bounded take per language: no language's rows meet in one window
        rows = train.where(F.col("lang") == lang).select("doc_id", "lang", order.alias("o")).orderBy("o", "doc_id").limit(max_labelled)
        drawn = rows if drawn is None else drawn.unionByName(rows)
    drawn = stored(drawn.select(F.col("doc_id").alias("i"), F.col("lang").alias("l")).distinct(), "langid-drawn")
    sample = train.join(drawn, (F.col("doc_id") == F.col("i")) & (F.col("lang") == F.col("l")), "left_semi").select("lang", "text")
    sample = stored(sample, "langid-train")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                if (x := gram_counts(text)) is not None:
                    have = sums.setdefault(lang, np.zeros(DIMS))
                    have += x / x.sum()
        yield pd.DataFrame({"lang": list(sums), "x": [v.tobytes() for v in sums.values()]})

    total = {lang: np.zeros(DIMS) for lang in langs}
    for r in sample.mapInPandas(count, "lang string, x binary").toLocalIterator():
        total[r.lang] += np.frombuffer(r.x)
    code = code_matrix(len(langs))
    sums = np.stack([total[lang] for lang in langs]) + 1e-4  # every document counts one; a little for unseen n-grams
    share = sums / sums.sum(axis=1, keepdims=True)
    weights, offsets = [], []
    for bit in code.T:
        if (bit == bit[0]).all():
            weights.append(np.full(DIMS, float(bit[0])))
            offsets.append(0.0)
            continue
        one, zero = share[bit == 1].mean(axis=0), share[bit == -1].mean(axis=0)
        w = np.log(one) - np.log(zero)
        ends = [float(s @ w) for s in share]
        weights.append(w)
        offsets.append((np.mean([e for e, b in zip(ends, bit) if b == 1]) + np.mean([e for e, b in zip(ends, bit) if b == -1])) / 2)
    weights, offsets = np.stack(weights), np.array(offsets)
    # One unit of margin is half of the mean distance between a bit's two sides.
    scale = np.array([max(1e-6, np.mean(np.abs(share @ w - o))) for w, o in zip(weights, offsets)])
    weights, offsets = weights / scale[:, None], offsets / scale
    place = {lang: i for i, lang in enumerate(langs)}

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        right, seen = np.zeros(len(offsets)), 0
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                if (x := gram_counts(text)) is not None:
                    right += np.sign(weights @ (x / x.sum()) - offsets) == code[place[lang]]
                    seen += 1
        yield pd.DataFrame({"x": [right.tobytes()], "n": [seen]})

    right, seen = np.zeros(len(offsets)), 0
    for r in sample.mapInPandas(hits, "x binary, n long").toLocalIterator():
        right, seen = right + np.frombuffer(r.x), seen + r.n
    accuracy = np.clip((right + 1) / (seen + 2), 0.5, 0.999)
    bit_weights = np.log(accuracy / (1 - accuracy)) + 1e-3
    return langs, code, weights, offsets, bit_weights / bit_weights.sum()


def decode(margins: np.ndarray, code: np.ndarray, bit_weights: np.ndarray) -> tuple[int, float, float]:
    """(codeword, score, gap to the runner-up) of one text's margins by weighted logistic loss."""
    loss = (np.logaddexp(0.0, -3.0 * code * margins) * bit_weights).sum(axis=1)
    order = np.argsort(loss, kind="stable")
    belief = np.exp(-4.0 * (loss - loss[order[0]]))
    gap = float(loss[order[1]] - loss[order[0]]) if len(order) > 1 else float("inf")
    return int(order[0]), float(1.0 / belief.sum()), gap


def predict(docs: DataFrame, model, keep: list[str] | None = None, gap: float = GAP) -> DataFrame:
    """``(keep..., lang_pred, score, ambiguous)`` for every row of ``docs(text, ...)``."""
    keep = keep or ["doc_id"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", lang_pred string, score double, ambiguous boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["text"]:
                x = gram_counts(text) if model else None
                if x is None:
                    rows.append(("und", 0.0, True))
                    continue
                langs, code, weights, offsets, bit_weights = model
                i, score, apart = decode(weights @ (x / x.sum()) - offsets, code, bit_weights)
                rows.append((langs[i], score, apart < gap))
            out = b[keep].copy()
            out["lang_pred"], out["score"], out["ambiguous"] = zip(*rows) if rows else ([], [], [])
            yield out

    return docs.select(*keep, "text").mapInPandas(run, schema)


def op5_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classified(docs)


def classified(docs: DataFrame, folds: int = FOLDS, held: int = HELD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, ambiguous)``; rows with crc32(doc_id) mod folds = held are not learned from."""
    side = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == held, F.lit(False))
    train = docs.where(~side & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")
    out = predict(docs, fit(train, max_labelled))
    return out.select("doc_id", side.alias("held_out"), "lang_pred", "score", "ambiguous")
