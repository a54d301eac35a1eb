"""CSV by header name, and stages that another process resumes."""

import subprocess
import sys
import tempfile

import pytest

from raretide.sources import entities, stages
from raretide.spec import REF_V4

ROOT = __file__.rsplit("/tests/", 1)[0]


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_scan_csv_reads_by_name(spark, tmp_path):
    path = write(str(tmp_path / "a.csv"), "id,feature_2,target,extra,feature_1\n1,7.25,1,x,0.5\n2,NA,0,y,NaN\n3,,1,z, 4 \n")
    rows = entities.scan_csv(spark, path, entities.entity_schema(2)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 1, 0.5, 7.25), (2, 0, None, None), (3, 1, 4.0, None)]
    with pytest.raises(ValueError):
        entities.scan_csv(spark, path, entities.entity_schema(3))
    bad = write(str(tmp_path / "b.csv"), "id,target,feature_1\n1,1,x7\n2,0,3\n")
    rows = entities.scan_csv(spark, bad, entities.entity_schema(1), rejected="bad").orderBy("id").collect()
    assert [(r.feature_1, r.bad) for r in rows] == [(None, 1), (3.0, 0)]


def test_input_key_follows_the_files(spark, tmp_path):
    path = write(str(tmp_path / "a.csv"), "x\n1\n")
    one = stages.input_key(spark, [path])
    assert one == stages.input_key(spark, [path])
    write(path, "x\n1\n2\n")
    assert one != stages.input_key(spark, [path])


def test_another_process_resumes_and_rebuilds(tmp_path):
    code = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from raretide.sources import stages
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
built = []
def build():
    built.append(1)
    return spark.range(5)
n = stages.stage(spark, "resumed", sys.argv[1], build).count()
print("BUILT", len(built), n)
"""
    script = write(str(tmp_path / "s.py"), code.format(root=ROOT, shared=str(tmp_path / "shared")))

    def go(fp):
        out = subprocess.run([sys.executable, script, fp], capture_output=True, text=True, timeout=200)
        return out.stdout.strip().splitlines()[-1]
    assert go("k1") == "BUILT 1 5"
    assert go("k1") == "BUILT 0 5"
    import os
    done = str(tmp_path / "shared/stages/resumed/fp=k1/_SUCCESS")
    os.rename(done, str(tmp_path / "half-written"))
    assert go("k1") == "BUILT 1 5"


def test_plan_prepares_any_tables_at_reference_width(spark):
    import random
    from raretide.plans.pipeline import PlanConfig, prepared_stage
    rnd = random.Random(1)
    cols = [f"feature_{i}" for i in range(1, 51)]
    rows = [[i, int(rnd.random() < 0.2)] + [None if rnd.random() < 0.05 else float(rnd.randint(0, 9)) if j % 3 else float(rnd.randint(0, 1)) for j in range(50)] for i in range(300)]
    schema = "id long, target int, " + ", ".join(f"{c} double" for c in cols)
    train = spark.createDataFrame(rows, schema)
    test = spark.createDataFrame([[1000 + r[0], *r[2:]] for r in rows[:60]], "id long, " + ", ".join(f"{c} double" for c in cols))
    tr, ts, feats, spw, _ = prepared_stage(train, test, PlanConfig(spec=REF_V4, n_bins=5), tempfile.mktemp())
    assert len(feats) >= 50 and set(cols) <= set(feats)
    assert tr.count() == 300 and ts.count() == 60 and spw > 1
