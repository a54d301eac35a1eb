"""The corpus pipeline: documents through operators of ``raretide.llm``.

Each stage is written as Parquet to the session's shared checkpoint folder and
read again as the next one's input.  All stages but the last return the columns
of their input; the mix adds none and returns its own report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from raretide.llm import decontaminate, mixing, quality, secrets, simhash
from raretide.llm.common import scratch, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (the smallest ``doc_id``)."""
    return simhash.keep_one_row(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are masked in the text; every document stays."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_redaction),
    ("source mixing", source_mix),
]

#: Learned scores, fingerprints and BM25 bounds are not SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
