"""SimHash near-duplicates with pigeonring candidate filtering.

A text's fingerprint has a bit set where over half of its shingles' XXH64
values (seed 42) have it set.  Two fingerprints link at ``max_bits`` or fewer
differing bits.  Candidates come from the pigeonring principle: cut the 64
bits into ``max_bits + 1`` segments on a ring; for every linked pair some
start segment exists from which the differences summed over any number l of
consecutive segments stay within l times the proportional budget
``max_bits / segments``.  So the start segment agrees exactly and the next one
differs by one bit at most: one side indexes the two-segment key, the other
probes it with every one-bit change of the second segment.  Longer chains are
checked on the join itself, before the full Hamming distance.

Only distinct fingerprints are compared, so a group of copies is one row.

Defined cases: a null or empty text, or one without words, has fingerprint
zero and links like any other; fewer words than the shingle length make one
shingle of all words; a null ``doc_id`` keeps its row and takes its
component's smallest id (null when no member has one); repeated rows come back
repeated; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import connected_components, stored, table

SHINGLE = 4
MAX_BITS = 4
SEED = 42
_BLOCK = 1 << 15
#: Probe keys that a task makes of its fingerprints.
KEYS_A_TASK = 1 << 20


def fingerprint_bytes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint of one text (a helper of :func:`fingerprints`)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for lo in range(0, last, _BLOCK):
        hashes = [digest(b" ".join(words[i:i + shingle]), seed) for i in range(lo, min(last, lo + _BLOCK))]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fp)`` for every row of ``docs``; ``fp`` is the signed long of the 64 bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint_bytes(t, shingle) for t in b["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": b["id"], "fp": fp.view(np.int64)})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of ``max_bits + 1`` segments that cover the 64 bits."""
    n = max_bits + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(n)]


def _part(value: Column, seg: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(value, seg[0]).bitwiseAND(F.lit((1 << seg[1]) - 1).cast("long"))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs ``(a, b)``, ``a < b``, of the distinct ``fps(fp)`` within ``max_bits`` differing bits."""
    segs = _segments(max_bits)
    n = len(segs)
    if max_bits == 0:
        return fps.where("false").select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    fp = F.col("fp")

    def key(start: int, second: Column) -> Column:
        wide = F.shiftleft(_part(fp, segs[start]), segs[(start + 1) % n][1]).bitwiseOR(second)
        return wide * F.lit(n) + F.lit(start)

    index, probe = [], []
    for i in range(n):
        nxt = segs[(i + 1) % n]
        own = _part(fp, nxt)
        index.append(key(i, own))
        probe.append(key(i, own))
        if 2 * max_bits // n >= 1:
            probe += [key(i, own.bitwiseXOR(F.lit(1 << j).cast("long"))) for j in range(nxt[1])]
    # a row becomes dozens: enough tasks for the rows that come out, not for the few bytes that go in
    rows = fps.count()
    fps = fps.repartition(max(1, -(-rows * len(probe) // KEYS_A_TASK)), "fp")
    left = fps.select(fp.alias("a"), F.explode(F.array(*probe)).alias("key"))
    right = fps.select(fp.alias("b"), F.explode(F.array(*index)).alias("key"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    start = F.pmod(F.col("key"), F.lit(n))
    counts = [F.bit_count(_part(diff, s)) for s in segs]
    chain = F.lit(False)
    for i in range(n):
        total, ok = F.lit(0), start == i
        for length in range(1, n + 1):
            total = total + counts[(i + length - 1) % n]
            ok = ok & (total <= length * max_bits // n)
        chain = chain | ok
    joined = left.join(right, "key").where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= max_bits) & chain)
    return joined.select("a", "b").distinct()


def components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``(id_col, fp, component_id)`` for every row; the component's smallest id, itself included."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    return fps.join(_lowest(fps, F.col(id_col), max_bits), "fp").select(id_col, "fp", F.col("low").alias("component_id"))


def _lowest(fps: DataFrame, rank: Column, max_bits: int) -> DataFrame:
    """``(fp, low)`` of every distinct ``fp``: the smallest ``rank`` among the rows of its component."""
    classes = stored(fps.groupBy("fp").agg(F.min(rank).alias("low")), "simhash-classes")
    found = stored(links(classes.select("fp"), max_bits), "simhash-links")
    roots = connected_components(found).withColumnRenamed("node", "fp")
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # both are written first: the joins have plain shuffles on either side then, so AQE splits
    # a component with many fingerprints and a fingerprint with many copies
    lows = stored(classes.groupBy("root").agg(F.min("low").alias("low")), "simhash-lows")
    return stored(classes.drop("low").join(lows, "root").select("fp", "low"), "simhash-named")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, repeated ones and those without an id too.

    Rows are judged one by one: an id that stands at several texts may stay at one and go at another.
    """
    tagged, fps = _tagged(docs, shingle, id_col, text_col)
    low = _lowest(fps, F.col("id"), max_bits)
    gone = fps.join(low, "fp").where(F.col("id") != F.col("low")).select("__row")
    return tagged.join(gone, "__row", "left_anti").select(*docs.columns)


def keep_one_row(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row of every component: the smallest by id (nulls last), fingerprint and text digest; of equal ones any."""
    tagged, fps = _tagged(docs, shingle, id_col, text_col)
    low = _lowest(fps, F.struct(F.col("id").isNull(), "id", "fp", "digest", "__row"), max_bits)
    gone = fps.join(low, "fp").where(F.col("__row") != F.col("low.__row")).select("__row")
    return tagged.join(gone, "__row", "left_anti").select(*docs.columns)


def _tagged(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a ``__row`` of their own, written so that it stays, and ``(__row, id, digest, fp)`` of them."""
    tagged = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    names = tagged.select("__row", F.col(id_col).alias("id"), F.sha2(F.col(text_col), 256).alias("digest"))
    return tagged, stored(fingerprints(tagged, shingle, "__row", text_col).join(names, "__row"), "simhash-fp")


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    comp = components(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return comp.select("doc_id", hexed.alias("fingerprint"), "component_id")
