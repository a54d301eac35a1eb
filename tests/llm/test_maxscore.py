import math
import random

from pyspark.sql import functions as F

from raretide.llm import maxscore


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for qi, q in ok:
        if qi % every:
            continue
        best = sorted(((-sum(a * b for a, b in zip(q, v)), i) for i, v in ok if i != qi))[:k]
        out |= {(qi, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def run(spark, rows, every=10, **params):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int")
    df = df.select("vec_id", maxscore.quantised(F.col("embedding")).alias("v"), "score", "rank")
    return {tuple(r) for r in maxscore.search(df, df.where(F.col("vec_id") % every == 0), 5, **params).collect()}


def test_search_equals_brute_force(spark):
    rnd = random.Random(4)
    f32 = lambda: rnd.randint(-300, 300) / 256
    rows = [(i, [f32() for _ in range(16)]) for i in range(400)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(60)] + [(500, [0.0] * 16), (510, [5.0] * 16)]
    rows += [(600, None), (610, [None] + [0.5] * 15), (620, [float("nan")] * 16), (630, [float("inf")] * 16), (None, [1.0] * 16)]
    assert run(spark, rows, shard_rows=90, query_block=8) == brute(rows, 5, 10)
    few = rows[:3]
    assert run(spark, few) == brute(few, 5, 10) and run(spark, []) == set()
    assert run(spark, rows[:1]) == set()


def test_probing_drops_candidates():
    import numpy as np
    rnd = np.random.default_rng(3)
    v = np.concatenate((rnd.integers(-20, 20, (4000, 24)), rnd.integers(90, 120, (8, 24))))
    stats = {}
    got = maxscore.Shard(np.arange(len(v)), v).search(np.arange(24) + 1, -1, 5, stats)
    want = sorted(((-int(x @ (np.arange(24) + 1)), i) for i, x in enumerate(v)))[:5]
    assert [(i, s) for i, s in got] == [(i, -s) for s, i in want]
    assert stats["probed"] < len(v)
