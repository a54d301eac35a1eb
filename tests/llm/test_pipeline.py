import random
import re

import corpus_pipeline
from raretide.llm import mixing
from raretide.llm.common import table
from tests.conftest import SF001
from tests.llm.test_mixing import level_targets
from tests.llm.test_simhash import brute_components, brute_fp


def stages(spark, docs, sf_dir):
    """Input and output of every stage."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        done = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema) if name != "source mixing" else stage(spark, docs, sf_dir)
        out.append((name, docs, done))
        docs = done
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, SF001, "documents")
    items = [r.text for r in table(spark, SF001, "benchmark").collect()]
    found = dict((n, (a, z)) for n, a, z in stages(spark, docs, SF001))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "secret scans", "source mixing"]
    for name, (a, z) in found.items():
        if name != "source mixing":
            assert z.columns == docs.columns
    # quality: labelled documents go and stay by their label, nearly all
    a, z = found["quality classifier"]
    label = {r.doc_id: r.quality for r in table(spark, SF001, "labels").collect()}
    kept = {r.doc_id for r in z.collect()}
    assert sum((d in kept) == bool(q) for d, q in label.items()) / len(label) > 0.95
    # near copies: the smallest id of every component
    a, z = found["simhash near-dedup"]
    rows = a.collect()
    comp = brute_components([r.doc_id for r in rows], [brute_fp(r.text) for r in rows])
    assert {r.doc_id for r in z.collect()} == {r.doc_id for r, c in zip(rows, comp) if r.doc_id == c}
    # test items: no whole item stays, and only documents that share long word runs with an item go
    a, z = found["benchmark decontamination"]
    kept = {r.doc_id for r in z.collect()}
    runs = {tuple(w[i:i + 5]) for t in items for w in [re.findall(r"\w+", t.lower())] for i in range(len(w) - 4)}
    for r in a.collect():
        if any(t in (r.text or "") for t in items):
            assert r.doc_id not in kept
        elif r.doc_id not in kept:
            w = re.findall(r"\w+", r.text.lower())
            assert any(tuple(w[i:i + 5]) in runs for i in range(len(w) - 4))
    # secrets: gone from the text, all documents stay, other texts untouched
    a, z = found["secret scans"]
    shapes = re.compile(r"AKIA[0-9A-Z]{16}|(?:token = \"|password=)[0-9a-f]{16,}")
    before, after = {r.doc_id: r for r in a.collect()}, {r.doc_id: r for r in z.collect()}
    assert set(before) == set(after)
    for d, r in after.items():
        assert not shapes.search(r.text or "")
        if not shapes.search(before[d].text or ""):
            assert r == before[d]
    # the mix
    a, z = found["source mixing"]
    sizes = {}
    for r in a.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want, taken = level_targets(sizes), {}
    for r in z.collect():
        assert r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 2 * mixing.BLOCK for s in sizes)


def test_run_reads_the_tables_and_survives_odd_rows(spark, tmp_path):
    rnd = random.Random(3)
    say = lambda n: " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]) + str(rnd.randint(0, 99)) for _ in range(n))
    rows = [(i, say(30), "en", "src1" if i % 3 else None, 5, "x") for i in range(40)]
    rows += [(None, None, None, None, None, None), (50, "", "en", "s", 0, ""), (51, say(20000), "en", "s", 1, "z"), (1, rows[1][1], "en", "src1", 5, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, target string"
    base = str(tmp_path / "tables")
    spark.createDataFrame(rows, schema).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    out = corpus_pipeline.run(spark, base).collect()
    assert {51, 1, 0} <= {r.doc_id for r in out} and len(out) >= 40
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    for t, s in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], s).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
