import zlib
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from raretide.llm import langid
from tests.conftest import SF01


def test_codes_are_apart():
    for n in (2, 3, 4, 5, 9, 20):
        code = langid.code_matrix(n)
        least = min(int((a != b).sum()) for a, b in combinations(code, 2))
        assert code.shape[0] == n and least >= (1 if n == 2 else 2)
        assert all(len(set(col)) == 2 for col in code.T)


def test_decoding_corrects_a_wrong_bit():
    code = langid.code_matrix(4)
    for i in range(4):
        for flip in range(code.shape[1]):
            m = code[i].astype(float)
            m[flip] *= -1
            assert langid.decode(m, code, np.full(len(m), 1 / len(m)))[0] == i


def test_held_out_accuracy(spark):
    out = langid.op5_language_codes(spark, SF01)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_cases(spark):
    say = {"en": "the cat and the other thing with that", "xx": "zopo qiqo zuqo poqo zizo"}
    rows = [(i, say["en" if i % 2 else "xx"] * (1 + i % 5), "en" if i % 2 else "xx") for i in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 ... !!", "xx"), (None, "the thing", "en"), (103, "zopo " * 50000, None), (1, rows[1][1], "en")]
    df = spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id long, text string, lang string, score double, held_out boolean")
    got = langid.classified(df).collect()
    assert len(got) == len(rows)
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "xx") for r in got if r.doc_id is not None and r.doc_id < 40)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {100, 101, 102}
    assert next(r for r in got if r.doc_id == 103).lang_pred == "xx"
    assert {r.lang_pred for r in langid.classified(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.classified(df.where("false")).count() == 0
    assert {r.lang_pred for r in langid.classified(df.where("lang = 'en' or doc_id = 101")).collect()} == {"en", "und"}
