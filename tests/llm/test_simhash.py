import random

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from raretide.llm import simhash
from raretide.llm.common import connected_components


def brute_fp(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for ws in "\t\n\x0b\x0c\r":
        words = words.replace(ws, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def test_links_equal_brute_force(spark):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(40)]
    pts = set(base)
    for b in base:
        for _ in range(20):
            p = b
            for bit in rnd.sample(range(64), rnd.randint(0, 6)):
                p ^= 1 << bit
            pts.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in pts]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert got == want and want


def test_components_and_edge_cases(spark):
    rnd = random.Random(7)
    words = [f"Wörd{i}" for i in range(300)]
    long = " ".join(rnd.choice(words) for _ in range(30000))
    rows = [(5, None), (3, ""), (9, " \t\n"), (1, "one two"), (2, "ONE\u0009two"), (None, "one two"),
            (None, "alone in here for all time"), (11, long), (12, long + " tail"), (11, long), (14, "a b c d e")]
    for i in range(20, 60):
        rows.append((i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40)))))
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    out = simhash.components(df).select("doc_id", "fp", "component_id").collect()
    fps = [brute_fp(t) for _, t in rows]
    comp = brute_components([d for d, _ in rows], fps)
    want = sorted(((d, f - (1 << 64) if f >> 63 else f, c) for (d, _), f, c in zip(rows, fps, comp)), key=str)
    assert sorted((tuple(r) for r in out), key=str) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(11) == 2 and 12 not in ids and 2 not in ids and 5 not in ids and 3 in ids
    assert ids.count(None) == 2
    assert simhash.components(df.where("false")).count() == 0


def test_connected_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(1, 1)]
    out = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 100 for i in range(100, 161)) and all(out[i] == 7 for i in range(200, 300)) and 1 not in out


def test_one_row_of_every_component_stays(spark):
    rnd = random.Random(11)
    a, b, c = (" ".join(f"{k}{rnd.randint(0, 10**6)}" for _ in range(60)) for k in "abc")
    rows = [(1, b, 0), (5, a, 1), (5, b, 2), (7, c, 3), (7, c, 4), (None, c, 5), (None, "alone in here for all time", 6), (None, "alone in here for all time", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, low int").repartition(3)
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(df).where("doc_id < 7").collect()) == [(1, b), (5, a)]
    kept = simhash.keep_one_row(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, b), (5, a), (7, c), (None, "alone in here for all time")], key=str)
    assert simhash.keep_one_row(df.where("false")).count() == 0


def test_the_pipeline_keeps_one_row_of_every_component(spark):
    df = spark.createDataFrame([(7, "one two three four five"), (7, "one two three four five"), (None, "one two three four five")], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()] == [7]
