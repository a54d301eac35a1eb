import random
import zlib

from pyspark.sql import functions as F

from raretide.llm import quality
from tests.conftest import SF01


def test_held_out_accuracy_and_columns(spark):
    out = quality.op10_quality_ranking(spark, SF01)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    lab = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = out.join(lab, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.collect())
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_edge_cases(spark):
    rnd = random.Random(2)
    say = lambda n: " ".join(f"word{rnd.randint(0, 900)}" for _ in range(n))
    rows = [(i, say(50) if i % 3 else say(50).upper() + "!!!") for i in range(60)]
    rows += [(None, None), (None, say(20)), (70, ""), (71, "  \n"), (72, say(40000)), (5, rows[5][1]), (5, rows[5][1])]
    docs = spark.createDataFrame([(d, t, 0.5, 1) for d, t in rows], "doc_id long, text string, score double, quality int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), None) for i in range(60)] + [(1, 0, 1), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.scored(docs, labels)
    got = out.collect()
    assert len(got) == len(rows) and all(r.score is not None for r in got)
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 60)
    assert quality.scored(docs.where("false"), labels).count() == 0
    assert {round(r.score, 6) for r in quality.scored(docs, labels.where("quality = 1")).collect()} == {quality.CUT}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 60").count() == 42
    assert quality.keep_good(docs, labels.where("false")).count() == len(rows)
