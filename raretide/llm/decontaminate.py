"""Benchmark decontamination: BM25 over test items with block-max WAND.

The test items are an inverted index.  A posting's impact is its BM25 weight
divided by the item's own total weight, so an item's full text scores 1 and one
threshold serves all items.  Every training text is cut into overlapping
passages; window and step come from the longest item, so any stretch as long as
an item lies whole in one passage.  Every passage is a query: all items at or
above the threshold are retrieved (no top-k), by WAND pivots on term bounds and
then on block bounds.  Before WAND a vectorised sum of the term bounds drops
passages that cannot reach the threshold, which is the same bound over all
items at once.

Retrieved items are verified on the passage: at least ``SIMILAR`` of the item's
five-word shingles occur there, and at least ``PART`` of the words of its
question and of its answer.  The answer is the ``answer`` column where there is
one, otherwise the item's last sentence (its second half, if it has one only).

The index holds every different item once (by the digest of text and answer); item ids are joined to the
verified matches in Spark, so equal items cost the index nothing.  It is collected in parts, cut where the
running count of postings passes a multiple of ``INDEX_ROWS``: a part holds at most that many and those of one
item more.  Each part is sent to the tasks and run over the documents; document counts come from
all items, repeated ones included.

Defined cases: null or wordless texts and items match nothing; items of fewer
than five words are one shingle; equal items each report; repeated documents
report each (one row per document row and item); an empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import string
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

THRESHOLD = 0.6
SIMILAR = 0.8
PART = 0.6
SHINGLE = 5
INDEX_ROWS = 20_000
ITEMS_A_BLOCK = 4
K1, B = 1.2, 0.75
#: Steps of a text whose block sums are held at once.
_STEPS = 256
_FOLD = bytes.maketrans(string.ascii_uppercase.encode() + string.punctuation.encode(),
                        string.ascii_lowercase.encode() + b" " * len(string.punctuation))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()


def question_and_answer(text: str, answer: str | None = None) -> tuple[list[bytes], list[bytes]]:
    if answer is not None:
        return words_of(text), words_of(answer)
    parts = [w for s in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if (w := words_of(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    return words[:(len(words) + 1) // 2], words[(len(words) + 1) // 2:]


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


class Index:
    """One part of the inverted index, as a task holds it."""

    def __init__(self, items: list[tuple], df: dict[bytes, int], n_items: int, mean_len: float, longest: int):
        """items: (item id or key, text, answer or None); df: items that hold a term, over all items."""
        self.ids, self.checks, posts = [], [], defaultdict(list)
        for item_id, text, answer in items:
            question, reply = question_and_answer(text, answer)
            words = words_of(text) if answer is None else question + reply
            if not words:
                continue
            tf, norm = Counter(words), K1 * (1 - B + B * len(words) / mean_len)
            w = {t: np.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + norm) for t, f in tf.items()}
            own = sum(w.values())
            for t, x in w.items():
                posts[t].append((len(self.ids), x / own))
            self.ids.append(item_id)
            self.checks.append((shingles(words), set(question), set(reply)))
        self.terms = {t: i for i, t in enumerate(posts)}
        self.docs = [[d for d, _ in p] for p in posts.values()]
        self.impacts = [[x for _, x in p] for p in posts.values()]
        self.bound = np.array([max(x) for x in self.impacts] + [0.0])
        # block bounds by item range, so that blocks of all terms line up
        blocks = len(self.ids) // ITEMS_A_BLOCK + 1
        self.block_bound = np.zeros((len(self.docs) + 1, blocks), dtype=np.float32)
        for t, (ds, xs) in enumerate(zip(self.docs, self.impacts)):
            for d, x in zip(ds, xs):
                self.block_bound[t, d // ITEMS_A_BLOCK] = max(self.block_bound[t, d // ITEMS_A_BLOCK], x)
        self.step = max(32, longest)
        self.window = 2 * self.step

    def search(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """Every item that scores the threshold or more for distinct term numbers ``query``."""
        found, at = [], {t: 0 for t in query}
        live = [t for t in query if self.docs[t]]
        n = len(self.ids)
        while live:
            live.sort(key=lambda t: self.docs[t][at[t]])
            total, pivot = 0.0, -1
            for k, t in enumerate(live):
                total += self.bound[t]
                if total >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                return found
            doc = self.docs[live[pivot]][at[live[pivot]]]
            while pivot + 1 < len(live) and self.docs[live[pivot + 1]][at[live[pivot + 1]]] == doc:
                pivot += 1
            block = doc // ITEMS_A_BLOCK
            if sum(self.block_bound[t, block] for t in live[:pivot + 1]) >= threshold - 1e-9:
                target = doc + 1
                if self.docs[live[0]][at[live[0]]] == doc:
                    score = sum(self.impacts[t][at[t]] for t in live[:pivot + 1])
                    if score >= threshold - 1e-9:
                        found.append((doc, float(score)))
                    move = live[:pivot + 1]
                else:
                    move, target = [t for t in live[:pivot] if self.docs[t][at[t]] < doc], doc
            else:
                # no item of this block can score: leave the block, but not past the next list's item
                nxt = self.docs[live[pivot + 1]][at[live[pivot + 1]]] if pivot + 1 < len(live) else n
                move, target = live[:pivot + 1], max(doc + 1, min((block + 1) * ITEMS_A_BLOCK, nxt))
            for t in move:
                at[t] = bisect_left(self.docs[t], target, at[t])
            live = [t for t in live if at[t] < len(self.docs[t])]
        return found

    def possible(self, ids: np.ndarray, threshold: float) -> Iterator[int]:
        """Numbers of the passages with a block whose summed bounds reach the threshold.

        A passage is two steps long; a step's sum counts each of its terms once.
        """
        last = -(-len(ids) // self.step)
        for first in range(0, last, _STEPS):
            here = ids[first * self.step:(first + _STEPS + 1) * self.step]
            steps = np.arange(len(here)) // self.step
            known = here >= 0
            pairs = np.unique(steps[known] * len(self.bound) + here[known])
            if not len(pairs):
                continue
            step, term = np.divmod(pairs, len(self.bound))
            heads = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1])))
            sums = np.zeros((_STEPS + 2, self.block_bound.shape[1]), dtype=np.float32)
            sums[step[heads]] = np.add.reduceat(self.block_bound[term], heads, axis=0)
            most = (sums[:-1] + sums[1:]).max(axis=1)
            yield from (first + np.flatnonzero(most[:_STEPS] >= threshold - 1e-4)).tolist()

    def matches(self, text: str | None, threshold: float) -> dict[int, tuple[float, float, float, float]]:
        """Item number to best (score, similarity, question, answer) of the verified passages of one text."""
        words = words_of(text)
        if not words or not self.ids:
            return {}
        ids = np.fromiter(map(self.terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        best: dict[int, tuple[float, float, float, float]] = {}
        for i in self.possible(ids, threshold):
            lo, hi = i * self.step, i * self.step + self.window
            query = np.unique(ids[lo:hi])
            query = query[query >= 0]
            hits = self.search(query.tolist(), threshold)
            if not hits:
                continue
            part = words[lo:hi]
            grams = {tuple(part[j:j + k]) for k in {SHINGLE, *(len(next(iter(self.checks[d][0]))) for d, _ in hits)}
                     for j in range(len(part) - k + 1)}
            there = set(part)
            for d, score in hits:
                own, question, answer = self.checks[d]
                got = (score, len(own & grams) / len(own), len(question & there) / max(1, len(question)), len(answer & there) / max(1, len(answer)))
                if got[1] >= SIMILAR and (not question or got[2] >= PART) and (not answer or got[3] >= PART) and got > best.get(d, (-1.0,)):
                    best[d] = got
        return best


def _keyed(items: DataFrame) -> DataFrame:
    """``(item_key, item_id, text, answer)`` of the items with a text; equal text and answer have equal keys."""
    answer = F.col("answer").cast("string") if "answer" in items.columns else F.lit(None).cast("string")
    rows = items.where("text is not null").select("item_id", "text", answer.alias("answer"))

    def digest(name: str) -> Column:
        return F.coalesce(F.sha2(F.col(name).cast("binary"), 256), F.lit("-"))

    return rows.select(F.concat(digest("text"), digest("answer")).alias("item_key"), "item_id", "text", "answer")


def _parts(items: DataFrame) -> Iterator[tuple]:
    """The index of ``_keyed`` items as bounded parts: (items, df, n_items, mean_len, longest)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [words_of(f"{t} {a}" if a is not None else t) for t, a in zip(b["text"], b["answer"])]
            yield b.assign(n=[len(w) for w in words], terms=[sorted({x.decode("utf-8", "surrogatepass") for x in w}) for w in words])

    distinct = items.groupBy("item_key").agg(F.first("text").alias("text"), F.first("answer").alias("answer"), F.count("*").alias("copies"))
    rows = distinct.mapInPandas(count, "item_key string, text string, answer string, copies long, n long, terms array<string>").where("n > 0")
    rows = stored(rows, "bm25-items")
    total = rows.agg(F.sum("copies"), F.sum(F.col("n") * F.col("copies")), F.max("n"), F.sum(F.size("terms"))).first()
    if not total[0]:
        return
    # running postings: totals of hash ranges of about an eighth of a part, then inside each range
    ranges = 8 * (-(-int(total[3]) // INDEX_ROWS))
    sized = rows.withColumn("range", F.pmod(F.xxhash64("item_key"), F.lit(ranges)))
    heads = sized.groupBy("range").agg(F.sum(F.size("terms")).alias("all"))
    heads = heads.select("range", (F.sum("all").over(Window.orderBy("range")) - F.col("all")).alias("head"))
    before = F.sum(F.size("terms")).over(Window.partitionBy("range").orderBy("item_key")) - F.size("terms")
    rows = sized.withColumn("before", before).join(heads, "range").withColumn("part", F.floor((F.col("head") + F.col("before")) / INDEX_ROWS))
    rows = stored(rows.select("item_key", "text", "answer", "copies", "terms", "part"), "bm25-parts")
    df = rows.select("part", "copies", F.explode("terms").alias("term"))
    counts = stored(df.groupBy("term").agg(F.sum("copies").alias("df"), F.collect_set("part").alias("at")), "bm25-df")
    for p in range(-(-int(total[3]) // INDEX_ROWS)):
        terms = {r.term.encode("utf-8", "surrogatepass"): r.df for r in counts.where(F.array_contains("at", p)).select("term", "df").toLocalIterator()}
        own = [(r.item_key, r.text, r.answer) for r in rows.where(F.col("part") == p).orderBy("item_key").toLocalIterator()]
        if own:
            yield own, terms, int(total[0]), int(total[1]) / int(total[0]), int(total[2])


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``(keep..., item_id, score, similarity, question, answer)`` per document row and verified item."""
    keep = keep or ["doc_id"]
    named = stored(_keyed(items), "bm25-keyed")
    found = stored(_found(docs, named, threshold, keep), "bm25-found")  # the documents are searched once, whatever the join does
    ids = named.select(F.col("item_key").alias("__key"), "item_id")
    return found.join(ids, F.col("item_key") == F.col("__key")).select(*keep, "item_id", "score", "similarity", "question", "answer")


def _found(docs: DataFrame, items: DataFrame, threshold: float, keep: list[str]) -> DataFrame:
    """``(keep..., item_key, score, similarity, question, answer)`` per document row and different verified item."""
    spark = docs.sparkSession
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", item_key string, score double, similarity double, question double, answer double"
    out = spark.createDataFrame([], schema)
    for part in _parts(items):
        sent = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = Index(*sent.value)
            for b in batches:
                found = [(k, index.ids[d], *x) for k, t in enumerate(b["text"]) for d, x in index.matches(t, threshold).items()]
                if found:
                    cols = list(zip(*found))
                    frame = b[keep].iloc[list(cols[0])].reset_index(drop=True)
                    for name, values in zip(("item_key", "score", "similarity", "question", "answer"), cols[1:]):
                        frame[name] = list(values)
                    yield frame

        out = out.unionByName(docs.select(*keep, "text").mapInPandas(run, schema))
    return out


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no test item.

    A row is judged by its own text where it lies, one part of the index after the other: no document is shuffled.
    """
    spark = docs.sparkSession
    for part in _parts(stored(_keyed(items), "bm25-keyed")):
        sent = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(*sent.value)
            for b in batches:
                clean = [not index.matches(t, threshold) for t in b.column("text").to_pylist()]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
