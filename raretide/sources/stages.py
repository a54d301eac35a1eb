"""Resumable stages: build a table once, reuse it on the next run.

``stage(spark, name, fingerprint, build)`` returns the Parquet table at
``<root>/stages/<name>/fp=<fingerprint>`` when it is complete, else runs
``build()`` and writes it there.  A stage is complete when Spark has finished the
table (``_SUCCESS``) and the commit record stands beside it: a small JSON file, written
last and moved into place, with the key, the table's path and the stage's metrics.  The root is a
plain shared folder without a per-application part (``raretide.stage.root``,
else ``spark.checkpoint.dir``), so another process resumes from the last
finished stage.  The fingerprint is part of the path and covers the input
files (:func:`input_key`): a change of data or parameters never reuses a
stale table, and a half-written one is built again.  Later steps, in this
process or another, read the metrics back from the record without a job
(:func:`stage_metrics`).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raretide.session import checkpoint_root, small_methods


def fingerprint(*parts) -> str:
    blob = json.dumps([str(p) for p in parts], sort_keys=True).encode()
    return hashlib.sha1(blob).hexdigest()[:16]


def stage_root(spark: SparkSession) -> str:
    """The folder of the stages, the same for every application that names it."""
    for name in ("raretide.stage.root", "spark.checkpoint.dir"):
        root = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name, None)
        if root:
            return root.rstrip("/")
    return checkpoint_root(spark)


def input_key(spark: SparkSession, paths: list[str]) -> str:
    """Fingerprint of the files under ``paths``: name, length and time, from whatever store holds them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        files = p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            parts.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return fingerprint(sorted(parts))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def stage_path(spark: SparkSession, name: str, fp: str, root: str | None = None) -> str:
    return f"{root or stage_root(spark)}/stages/{name}/fp={fp}"


COMMIT = "_commit.json"
Metric = tuple[str, int | None, str, float | None]  # model, fold, metric, value


def is_complete(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}/_SUCCESS") and _exists(spark, f"{path}/{COMMIT}")


def _commit(spark: SparkSession, path: str, record: dict) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMIT}")
    part = jvm.org.apache.hadoop.fs.Path(f"{path}/_{uuid.uuid4().hex}.part")
    fs = final.getFileSystem(conf)
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    fs.delete(final, False)
    if not fs.rename(part, final):
        raise OSError(f"no commit record at {path}")


def _record(spark: SparkSession, path: str) -> dict:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMIT}")
    stream = p.getFileSystem(conf).open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def stage(spark: SparkSession, name: str, fp: str, build: Callable[[], DataFrame], root: str | None = None,
          partition_by: list[str] | None = None, metrics: Callable[[DataFrame], list[Metric]] | None = None) -> DataFrame:
    """Read the finished stage or build, write and read it back (lineage cut).

    ``metrics`` measures the written table once; its few rows go into the commit record.
    """
    path = stage_path(spark, name, fp, root)
    if not is_complete(spark, path):
        with small_methods(spark):
            w = build().write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            rows = metrics(spark.read.parquet(path)) if metrics else []
        _commit(spark, path, {"key": fp, "table": path, "metrics": [list(r) for r in rows]})
    return spark.read.parquet(path)


def stage_metrics(spark: SparkSession, name: str, fp: str, root: str | None = None) -> list[Metric] | None:
    """The metrics of a finished stage, from its commit record (None when it is not finished)."""
    path = stage_path(spark, name, fp, root)
    return [tuple(r) for r in _record(spark, path)["metrics"]] if is_complete(spark, path) else None
