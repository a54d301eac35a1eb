from collections import Counter, defaultdict

import pytest

from raretide.llm import mixing


def level_targets(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    """Share, cut what is above, share the rest again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        tot = sum(w[s] for s in open_)
        above = [s for s in open_ if left * w[s] / tot > most * sizes[s]]
        if not above:
            out.update({s: left * w[s] / tot for s in open_})
            break
        for s in above:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in above)
        open_ -= set(above)
    return out


def highest(votes, seats):
    got = Counter()
    for _ in range(seats):
        best = max(votes, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return dict(got)


def test_sainte_lague_equals_one_by_one(spark):
    cases = {1: ({0: 100, 1: 100, 2: 1}, 7), 2: ({i: (i * 37) % 50 for i in range(30)}, 11), 3: ({0: 5}, 9),
             4: ({i: 10 for i in range(6)}, 4), 5: ({i: 1000 + i for i in range(8)}, 400), 6: ({0: 7, 1: 3}, 0)}
    rows = [(g, i, v, q) for g, (vs, q) in cases.items() for i, v in vs.items()]
    df = spark.createDataFrame(rows, "g int, i int, v long, q long")
    out = defaultdict(dict)
    for r in mixing.sainte_lague(df, ["g"], "i", "v", "q", "n").collect():
        if r.n:
            out[r.g][r.i] = r.n
    for g, (vs, q) in cases.items():
        assert out[g] == highest(vs, q), g


def test_mix_contract_and_edge_cases(spark):
    rows, k = [], 0
    for s, n, words in (("a", 40, 900), ("B", 3, 50), (None, 5, 400), ("é", 1, 60000), ("empty", 4, 0)):
        for i in range(n):
            rows.append((k, "w " * words if words or i else None, s))
            k += 1
    rows += [(None, "x y z", "a"), (0, "w " * 900, "a"), (0, "w " * 900, "a")]
    df = spark.createDataFrame([(*r, 5, "t") for r in rows], "doc_id long, text string, source string, size int, target string")
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").replace(" ", "_").split())
    want = level_targets(sizes)
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * mixing.BLOCK, (s, taken[s], want[s])
    again = mixing.mix(df.repartition(5)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    assert mixing.mix(df.where("false")).count() == 0
    assert {r.taken for r in mixing.mix(df.where("source = 'empty'")).collect()} == {0}


def test_small_sources_reach_their_targets(spark):
    rows, k = [], 0
    for s, n, words in (("two", 1, 2), ("sixty", 3, 20), (None, 5, 50), ("big", 30, 500), ("one", 1, 1)):
        for _ in range(n):
            rows.append((k, "w " * words, s))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = level_targets(sizes)
    for params in ({}, {"shard_words": 100}, {"block": 16}):
        taken = Counter()
        for r in mixing.mix(df, **params).collect():
            assert 0 <= r.taken <= 2 * r.size
            taken[r.source] += r.taken
        block = params.get("block", mixing.BLOCK)
        shards = {s: max(1, -(-sizes[s] // params.get("shard_words", mixing.SHARD_WORDS))) for s in sizes}
        for s in sizes:  # one block per source, and the shorter last block of each shard that is taken whole
            assert abs(taken[s] - want[s]) <= block * (1 + (shards[s] if shards[s] > 1 else 0)), (s, taken[s], want[s], params)
    got = Counter()
    for r in mixing.mix(df).collect():
        got[r.source] += r.taken
    assert want["sixty"] == got["sixty"] == 120 and want[None] == got[None] == 500


def test_quota_beyond_a_shard_goes_to_its_source(spark):
    shards = spark.createDataFrame([("a", 0, 64, 5), ("a", 1, 640, 2), ("a", 2, 640, 10), (None, 0, 64, 3)], "source string, shard long, shard_size long, blocks long")
    got = {(r.source, r.shard): r.blocks for r in mixing.held_quotas(shards, 128, 2).collect()}
    assert got == {("a", 0): 1, ("a", 1): 6, ("a", 2): 10, (None, 0): 1}
