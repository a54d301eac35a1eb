import hashlib
import random
from collections import Counter

import numpy as np

from raretide.llm import suffixes
from tests.conftest import SF001


def test_suffix_array_and_prefixes():
    rnd = random.Random(1)
    for text in (b"banana", b"a" * 300, b"ab" * 200, bytes(rnd.choice(b"ab") for _ in range(700)), b"x", b"\x00\x00\xff\x00" * 9):
        raw = np.frombuffer(text, np.uint8)
        sa = suffixes.suffix_array(raw)
        assert [text[i:] for i in sa] == sorted(text[i:] for i in range(len(text)))
        got = suffixes.common_prefixes(raw, sa, 50, stretches=7)
        for k in range(1, len(sa)):
            a, b, n = text[sa[k - 1]:], text[sa[k]:], 0
            while n < 50 and n < len(a) and n < len(b) and a[n] == b[n]:
                n += 1
            assert got[k] == n


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        lo, _ = suffixes.runs(gone)
        out.append((len(r), int(gone.sum()), len(lo), hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


def check(spark, ids, texts, length, **params):
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in zip(ids, texts)], "doc_id long, text string, n_spans int, sha string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeats(df, length, **params).collect()), key=str)
    assert got == sorted(((d, *x) for d, x in zip(ids, brute(texts, length))), key=str)


def test_repeats_equal_brute_force_with_many_shards(spark):
    rnd = random.Random(11)
    say = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    shared = [say(120) for _ in range(6)]
    texts = []
    for i in range(120):
        t = say(rnd.randint(0, 150))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared)
            a = rnd.randint(0, 60)
            t += p[a:a + rnd.randint(10, 120)] + say(rnd.randint(0, 40))
        texts.append(t)
    near = say(900)
    for _ in range(15):
        k = rnd.randint(0, 899)
        texts.append(near[:k] + "#" + near[k + 1:])
    texts += ["a" * 500, "ab" * 300, None, "", "short", texts[3], texts[3], near, say(30000) + shared[0] + say(10), None]
    ids = [*range(len(texts) - 2), 3, None]
    check(spark, ids, texts, 40, gram=12, shard_bytes=700, range_keys=300)


def test_repeats_on_documents_and_empty(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    check(spark, [r.doc_id for r in rows], [r.text for r in rows], 400)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.repeats(df).count() == 0
