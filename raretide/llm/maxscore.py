"""Exact top-k inner product search by MaxScore.

A vector's components are its terms.  For a query component q_d a posting's
contribution is |q_d| times the distance of its value from the end of the
shard's value range that hurts most, so contributions are never negative and
each term has the bound |q_d| * (max_d - min_d); the true score differs by a
constant of query and shard.  In falling order of bound, the terms are split:
the last ones, whose bounds together cannot lift a vector from nothing to the
threshold, are non-essential.  The postings of the essential terms are
traversed, then the others are probed one by one, and only while a candidate's
partial score plus what is left can still reach the threshold.  The threshold
is the k-th best full score so far, within the shard.

The index is cut into shards of at most ``shard_rows`` vectors; a block of
queries goes to every shard (a stated query set against all rows, in blocks),
and the shards' best k are merged by a partial sort per query.

Defined cases: vectors that are null or hold null or non-finite components take
no part, neither as queries nor as candidates; of vectors of different lengths
the missing components count as zero; a candidate with the query's own id is
left out; a null id takes no part; repeated rows are separate candidates; ties
go to the smaller id; an empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

TOP = 5
EVERY = 50
FACTOR = 256
SHARD_ROWS = 8192
QUERY_BLOCK = 1024


class Shard:
    """Postings of one shard, component by component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        """ids ascending; vectors (n, d) of int64."""
        self.ids, self.columns = ids, np.ascontiguousarray(vectors.T)
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        spread = self.columns.astype(np.float64)
        # the places of the largest and smallest values of each component: where first full scores are taken
        ends = min(len(ids), 64)
        self.tops = np.argpartition(spread, len(ids) - ends, axis=1)[:, len(ids) - ends:]
        self.bottoms = np.argpartition(spread, ends - 1, axis=1)[:, :ends]

    def search(self, query: np.ndarray, own: int, k: int, stats: dict | None = None) -> list[tuple[int, int]]:
        """The k best (vec_id, score) for integer vector ``query``, ties to the smaller id."""
        d = min(len(query), len(self.low))
        q = query[:d]
        base = np.where(q >= 0, self.low[:d], self.high[:d])
        bound = np.abs(q) * (self.high[:d] - self.low[:d])
        constant = int(q @ base)
        terms = np.argsort(-bound, kind="stable")
        terms = terms[bound[terms] > 0]
        left = np.concatenate((np.cumsum(bound[terms][::-1])[::-1], [0]))  # left[i]: bounds of terms i and later
        # first full scores, from the ends of the strongest terms' postings
        seeds = np.unique(np.concatenate([(self.tops if q[t] > 0 else self.bottoms)[t] for t in terms[:8]])) if len(terms) else np.arange(min(len(self.ids), 4 * k))
        seeds = seeds[self.ids[seeds] != own]
        full = q @ self.columns[:d, seeds]
        floor = np.partition(full, len(full) - k)[len(full) - k] - constant if len(full) >= k else np.int64(0)
        # essential: the terms before which nothing is gained by the rest alone
        essential = int(np.searchsorted(-left, -floor, side="right"))
        rows = None
        score = np.zeros(len(self.ids), dtype=np.int64)
        for i, t in enumerate(terms):
            gain = self.columns[t] if rows is None else self.columns[t][rows]
            score += q[t] * (gain - base[t])
            if i + 1 < essential or (i + 1 - essential) % 4:
                continue
            keep = score + left[i + 1] >= floor
            if rows is None or keep.sum() < 0.9 * len(score):
                rows, score = (np.flatnonzero(keep) if rows is None else rows[keep]), score[keep]
            if len(score) > k:
                floor = max(floor, np.partition(score, len(score) - k - 1)[len(score) - k - 1])  # one of them may be the query's own
            if stats is not None:
                stats["probed"] = stats.get("probed", 0) + len(score)
        rows = np.arange(len(self.ids)) if rows is None else rows
        keep = self.ids[rows] != own
        rows, score = rows[keep], score[keep] + constant
        best = np.lexsort((self.ids[rows], -score))[:k]
        return [(int(self.ids[rows[b]]), int(score[b])) for b in best]


def quantised(vector: Column, factor: int = FACTOR) -> Column:
    """floor(factor * x) of every component as a long; null where a component is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(doubles, lambda x: F.floor(x * F.lit(factor)).cast("long")))


def search(vectors: DataFrame, queries: DataFrame, k: int = TOP, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows of ``vectors(vec_id, v)`` per row of ``queries(vec_id, v)``.

    ``v`` are arrays of longs (see :func:`quantised`).
    """
    vectors = stored(vectors.where("vec_id is not null and v is not null").select("vec_id", "v"), "maxscore-index")
    queries = stored(queries.where("vec_id is not null and v is not null").select("vec_id", "v").distinct(), "maxscore-queries")
    n, m = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // query_block))
    held = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # Each (shard, block) is one unit of work: a shard meets its query blocks one after the other in bounded groups.
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def rectangle(values: pd.Series) -> np.ndarray:
        width = max(map(len, values), default=0)
        out = np.zeros((len(values), width), dtype=np.int64)
        for i, v in enumerate(values):
            out[i, :len(v)] = v
        return out

    def run(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(own) and len(ask):
            own = own.sort_values("vec_id", kind="stable")
            index = Shard(own["vec_id"].to_numpy(), rectangle(own["v"]))
            for qid, q in zip(ask["vec_id"], rectangle(ask["v"])):
                rows += [(int(qid), v, s) for v, s in index.search(q, qid, k)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_maxscore_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("v"))
    return search(rows, rows.where(F.col("vec_id") % EVERY == 0))


SQL = f"""
WITH v AS (SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor({FACTOR}::DOUBLE * x::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q, v c WHERE q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {TOP}
"""
