import hashlib
import random

import numpy as np

from raretide.llm import multiset_hash as mh
from tests.conftest import SF001


def test_sums_are_homomorphic_and_blind_to_order():
    a, b, c = "one paragraph of some length", "another, quite different paragraph", "one paragraph of some length"
    total = mh.paragraph_sum("\n".join((a, b, c)).encode())
    assert np.array_equal(total, mh.paragraph_sum("\n".join((b, c, a)).encode()))
    assert np.array_equal(total - mh.paragraph_sum(b.encode()), mh.paragraph_sum(f"{a}\n{c}".encode()))
    assert not np.array_equal(total, mh.paragraph_sum(f"{a}\n{b}".encode()))
    assert not np.array_equal(mh.paragraph_sum(b""), mh.paragraph_sum(b"\n"))


def test_sketch_is_the_same_in_any_stretch(monkeypatch):
    rnd = random.Random(2)
    text = "".join(rnd.choice("abc de\n") for _ in range(4000)).encode()
    whole = mh.paragraph_sum(text)
    assert np.array_equal(whole, sum((mh.paragraph_sum(p) for p in text.split(b"\n")), np.zeros_like(whole)))
    for stretch in (13, 100, 999):
        monkeypatch.setattr(mh, "STRETCH", stretch)
        assert np.array_equal(whole, mh.paragraph_sum(text))


def test_likeness_follows_shared_strings():
    rnd = random.Random(3)
    say = lambda n: "".join(rnd.choice("abcdefghij klmnop") for _ in range(n))
    for _ in range(20):
        a, b = say(2000), say(2000)
        own, other, mixed = (mh.paragraph_sum(t.encode()) for t in (a, b, a[:1500] + b[:500]))
        assert mh.likeness(own, own) == 1.0 and mh.likeness(own, other) < 0.25
        assert abs(mh.likeness(own, mixed) - 0.75) < 0.15
    empty = mh.paragraph_sum(b"")
    assert mh.likeness(empty, empty) == 1.0 and mh.likeness(empty, own) == 0.0


def test_edited_sum_equals_a_sum_from_nothing():
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rnd.choice("ab é🎈\n") for _ in range(rnd.randint(0, 60))) for _ in range(2))
        changed, at = mh.edit(a, b)
        n = len(a) // 4
        assert changed == a[:len(a) - n] + b[:n]
        assert np.array_equal(mh.edited_sum(mh.paragraph_sum(a.encode()), a, changed, at), mh.paragraph_sum(changed.encode()))


def brute(rows):
    """(doc_id, n_chars, edited_sha256) and the next text of every (doc_id, text)."""
    rows = [(d, t or "") for d, t in rows]
    first = {}
    for d, t in rows:
        first[d] = min(first.get(d, t), t, key=lambda s: s.encode())
    ids = sorted((d for d in first if d is not None)) + ([None] if None in first else [])
    after = dict(zip(ids, ids[1:] + ids[:1]))
    out = []
    for d, t in rows:
        nxt = first[after[d]]
        n = len(t) // 4
        changed = t[:len(t) - n] + nxt[:n]
        sums = [mh.paragraph_sum(x.encode()) for x in (t, changed, nxt)]
        out.append((str(d), len(t), hashlib.sha256(changed.encode()).hexdigest(), mh._name(sums[0]), mh._name(sums[1]),
                    round(mh.likeness(sums[0], sums[1]), 12), round(mh.likeness(sums[0], sums[2]), 12)))
    return sorted(out)


def check(df, rows, partitions):
    got = mh.fingerprints(df, partitions=partitions).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12)) for r in got) == brute(rows)


def test_fingerprints_equal_brute_force(spark):
    rnd = random.Random(9)
    say = lambda n: "".join(rnd.choice("abcdé 漢\n") for _ in range(n))
    rows = [(i * 3 - 200, say(rnd.randint(0, 90))) for i in range(160)]
    rows += [(7, say(30)) for _ in range(90)] + [(None, say(20)) for _ in range(60)] + [(50, "same text")] * 70  # hot ids
    rows += [(1 << 60, say(40)), ((1 << 60) + 1, say(40)), (901, None), (902, ""), (903, "x"), (904, say(20000)), (905, rows[3][1])]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(d, t, "clash", 0) for d, t in rows], "doc_id long, text string, fingerprint string, slot int").repartition(5)
    for partitions in (1, 2, 7, 40):
        check(df, rows, partitions)


def test_documents_small_tables_and_empty(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    check(df, [tuple(r) for r in df.collect()], 8)
    for rows in ([], [(1, "only one text")], [(None, None)], [(1, "a\nb"), (1, "c\nd")]):
        check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 3)


def test_equal_texts_have_equal_fingerprints_and_near_copies_are_nearer(spark):
    rows = mh.op13_document_fingerprints(spark, SF001).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    by_text = {}
    for r in rows:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    long = [r for r in rows if r.n_chars > 400 and r.near_next < 1]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.98
    assert abs(np.mean([r.near_edited for r in long]) - 0.75) < 0.05 and np.mean([r.near_next for r in long]) < 0.15
