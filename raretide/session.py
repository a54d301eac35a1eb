"""Session helpers: a local session for tests/bench and the shared stage folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Bytecode of a generated method that the JVM still compiles; longer ones stay interpreted.
JIT_LIMIT = 8000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "raretide") -> SparkSession:
    """Local session used by tests and the bench (the UI stays off)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only when nothing is configured (local runs, tests) a
    folder is created here and registered, so that ``DataFrame.checkpoint``
    and :mod:`raretide.sources.stages` agree on one location.
    """
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get().rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            # A machine-local folder is invisible to the other executors and
            # lost with this host: a cluster must name a shared folder.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        root = tempfile.mkdtemp(prefix="raretide-ckpt-", dir=os.environ.get("RARETIDE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(root)
    # setCheckpointDir adds a per-application sub-folder; report that one so
    # every later call returns the same path.
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Plans made inside give up whole-stage code whose methods the JVM would leave interpreted (wide projections)."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), JIT_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(name, before)
