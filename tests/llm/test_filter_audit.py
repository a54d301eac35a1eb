import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np

from raretide.llm import filter_audit
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    t = text or ""
    words = WORD.findall(t)
    return len(words), len(set(words)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))


def measured(texts, block):
    raws = [(t or "").encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raws]))).astype(np.int64)
    return [tuple(r) for r in filter_audit.measure(np.frombuffer(b"".join(raws), np.uint8), offsets, block).tolist()]


def some_texts(seed, n):
    rnd = random.Random(seed)
    say = lambda: "".join(rnd.choice(["a", "B", "é", "漢", "🎈", "#", "|", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", " ", "\0"]) for _ in range(rnd.randint(0, 80)))
    texts = [say() for _ in range(n)]
    return texts + ["", None, " ", "word", " word ", "x" * 5000, "ab " * 3000, "Aé# " * 700 + "tail", "same word same word", "a", "a", "", ""]


def test_transducer_equals_regex_in_any_block():
    texts = some_texts(1, 300)
    want = [plain(t) for t in texts]
    for block in (1, 7, 64, 1000, 1 << 20):
        assert measured(texts, block) == want
    assert measured([], 10) == []
    assert measured(["", None], 10) == [(0, 0, 0, 0, 0)] * 2


def test_table_verifies_bytes_when_all_keys_collide(monkeypatch):
    texts = ["one two one three two", "two one", "aa ab ba bb aa ab", "x " * 50 + "y z x"]
    monkeypatch.setattr(filter_audit, "span_keys", lambda hashes, owners: np.full(len(hashes), 7, np.uint64))
    for block in (8, 1 << 20):
        assert measured(texts, block) == [plain(t) for t in texts]


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    low = {}
    for d, t, _ in docs:
        if d is not None:
            low[t or ""] = min(d, low.get(t or "", d))
    parts = defaultdict(list)
    for d, t, s in docs:
        w, u, c, n, y = plain(t)
        fails = {x for x, bad in zip("ABCDE", (w < 200, 100 * u < 50 * w, 100 * c > 2 * n, y > 0, d is not None and low[t or ""] < d)) if bad}
        parts[s or ""].append((fails, d in good, d in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(rows)
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                shapley[x] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(x in r[0] for r in rows) - len(gone), sum(r[0] == {x} for r in rows),
                                          sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def result(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit_equals_brute_force(spark):
    rnd = random.Random(4)
    long = [" ".join(rnd.choice(["w%d" % i for i in range(k)]) for _ in range(260)) for k in (20, 90, 4000)]
    texts = some_texts(2, 60) + [t + x for t in long for x in ("", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEFGHIJKLMNOPQRSTUVWXYZ")] * 4
    docs = [(i if i % 17 else None, t, rnd.choice(["s1", "s2", "", None])) for i, t in enumerate(texts)]
    docs += [docs[5], docs[5], docs[70]]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 120)] + [(5, 1, 0), (6, 0, 1), (None, 1, 1), (9999, 1, 1)]
    df = spark.createDataFrame([(*d, "clash", 3) for d in docs], "doc_id long, text string, source string, part string, fails int")
    lf = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert result(filter_audit.audit(df, lf)) == brute(docs, labels)
    assert filter_audit.audit(df.limit(0), lf).count() == 0
    none = result(filter_audit.audit(df, lf.limit(0)))
    assert {k: v[:4] + [0, 0] + v[6:] for k, v in brute(docs, labels).items()} == none


def test_audit_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    want = {r[:3]: list(r[3:]) for r in con.execute(filter_audit.SQL).fetchall()}
    got = result(filter_audit.op11_filter_audit(spark, SF001))
    assert got == want and len(got) == 600 * len({k[0] for k in got})
