"""Helpers shared by the operators: table access, shared folders, components."""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.session import checkpoint_root


_BASE = 0xA24BAED4963EE407
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        line = np.full(size, base, dtype=np.uint64)
        line[0] = 1
        out.append(np.multiply.accumulate(line))
    return out[0], out[1]


def hash_power(n: int) -> int:
    """What the hash of a string is multiplied by when n bytes precede it."""
    return pow(_BASE, n, 1 << 64)


def running_hash(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, back) of a byte array: (sums[z] - sums[a]) * back[a] is a 64-bit hash of raw[a:z], wherever it stands."""
    up, back = _powers(1 << max(16, len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64, out=sums[1:])
    return sums, back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node of the undirected ``edges(a, b)``.

    Alternating large-star/small-star rounds: every round joins each edge with
    the least neighbour of one end (a skewed equi-join that AQE may split) and
    writes the new edge set to the shared folder, so no group of a component is
    gathered in a task.  Returns ``(node, root)``; nodes without an edge to
    another node do not appear.
    """
    spark = edges.sparkSession
    checkpoint_root(spark)
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = stored(cur, "cc")
    last = None
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        nxt = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = nxt.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        cur = stored(nxt, "cc")
        mark = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == last:
            break
        last = tuple(mark)
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
