import random

import numpy as np

from raretide.llm import decontaminate as dc


def test_wand_finds_all_above_threshold():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(120)]
    items = [(i, " ".join(rnd.choice(vocab[:40] if rnd.random() < 0.5 else vocab) for _ in range(rnd.randint(4, 30))), None) for i in range(90)]
    df = {}
    for _, t, _ in items:
        for w in set(dc.words_of(t)):
            df[w] = df.get(w, 0) + 1
    lens = [len(dc.words_of(t)) for _, t, _ in items]
    index = dc.Index(items, df, len(items), float(np.mean(lens)), max(lens))
    for th in (0.2, 0.5, 0.9):
        for _ in range(60):
            q = sorted(rnd.sample(range(len(index.docs)), rnd.randint(1, 60)))
            brute = {}
            for t in q:
                for d, x in zip(index.docs[t], index.impacts[t]):
                    brute[d] = brute.get(d, 0) + x
            want = {d: x for d, x in brute.items() if x >= th - 1e-9}
            got = dict(index.search(q, th))
            assert set(got) == set(want) and all(abs(got[d] - want[d]) < 1e-9 for d in got)


def test_leaks_and_edge_cases(spark):
    rnd = random.Random(9)
    vocab = [f"tok{i}" for i in range(3000)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, f"{say(20)}. {say(8)}.") for i in range(20)] + [(90, None), (91, ""), (92, "short item"), (20, say(9))]
    doc = lambda *x: " ".join(x)
    edited = items[3][1].split()
    edited[1] = "other"
    rows = [(1, doc(say(500), items[0][1].upper(), say(3000))), (2, say(4000)), (3, None), (4, ""), (5, doc(say(70), " ".join(edited))),
            (6, doc(say(50), items[4][1][: len(items[4][1]) // 2], say(50))), (7, doc(say(60000), items[7][1])), (7, doc(say(60000), items[7][1])),
            (None, items[9][1]), (8, "a short   ITEM, here")]
    df = spark.createDataFrame([(d, t, 1, 2.0) for d, t in rows], "doc_id long, text string, item_id int, score double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dc.leaks(df, bench)
    got = sorted(((r.doc_id, r.item_id) for r in out.collect()), key=str)
    assert got == sorted([(1, 0), (5, 3), (7, 7), (7, 7), (None, 9), (8, 92)], key=str)
    kept = dc.keep_clean(df, bench)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect())) == [2, 3, 4, 6]
    assert dc.leaks(df, bench.where("false")).count() == 0 and dc.leaks(df.where("false"), bench).count() == 0
    before = dc.INDEX_ROWS
    dc.INDEX_ROWS = 60
    try:
        assert sorted(((r.doc_id, r.item_id) for r in dc.leaks(df, bench).collect()), key=str) == got
    finally:
        dc.INDEX_ROWS = before


def test_equal_items_are_indexed_once_and_all_report(spark):
    texts = [f"alpha{i} beta{i} gamma{i} delta{i}. omega{i} sigma{i} theta{i} kappa{i}." for i in range(12)]
    items = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[3]) for i in range(30)] + [(None, texts[4]), (5, texts[5])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(1, f"x {texts[3]} y"), (2, texts[4]), (3, texts[5]), (4, "nothing of the kind")], "doc_id long, text string")
    before = dc.INDEX_ROWS
    for size in (before, 20):
        dc.INDEX_ROWS = size
        try:
            parts = list(dc._parts(dc._keyed(bench)))
            out = sorted(((r.doc_id, r.item_id) for r in dc.leaks(df, bench).collect()), key=str)
            kept = [r.doc_id for r in dc.keep_clean(df, bench).collect()]
        finally:
            dc.INDEX_ROWS = before
        assert sum(len(p[0]) for p in parts) == 12 and all(p[2] == len(items) for p in parts)
        assert all(sum(len(set(dc.words_of(t))) for _, t, _ in p[0]) < size + 8 for p in parts)
        assert out == sorted([(1, 3), *((1, 100 + i) for i in range(30)), (2, 4), (2, None), (3, 5), (3, 5)], key=str) and kept == [4]


def test_documents_are_not_shuffled_to_drop_those_with_items(spark):
    texts = [f"alpha{i} beta{i} gamma{i} delta{i}. omega{i} sigma{i} theta{i} kappa{i}." for i in range(12)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")
    big = 2**60 + 1  # no double holds it
    rows = [(big, f"x {texts[3]} y", None), (big, "nothing of the kind", [1, None]), (None, None, []), (big + 2, "nothing of the kind", None), (None, texts[8], [2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, more array<int>").coalesce(1)
    before = dc.INDEX_ROWS
    for size in (before, 20):
        dc.INDEX_ROWS = size
        try:
            kept = dc.keep_clean(df, bench)
        finally:
            dc.INDEX_ROWS = before
        assert kept.schema == df.schema and [tuple(r) for r in kept.collect()] == rows[1:4]
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
