"""Document fingerprints by a homomorphic multiset hash over paragraphs.

A paragraph (the text between line feeds) hashes to a wide vector of 32-bit lanes, a
text to the sum of its paragraphs' vectors modulo 2^32.  So the order of paragraphs
does not matter, and a paragraph is inserted or deleted by adding or subtracting its
vector.  The lanes are of two kinds:

* ``DIGEST_LANES`` uniform lanes, drawn from the paragraph's SHAKE-128: two texts
  have equal sums when they are the same multiset of paragraphs, and by chance else
  (2^-1024 for 32 lanes of honest text).
* ``SKETCH_LANES`` lanes to which every string of ``GRAM`` bytes of the paragraph adds
  +1 or -1 in the lane its hash picks (a shorter paragraph is one string).  Inner
  products of such sums estimate those of the counts of the strings, so the cosine
  tells how alike two texts are, with a standard error of about 1 / sqrt(lanes).

The edited text replaces the end of a text by the beginning of the next document.  Its
fingerprint is the text's, less the paragraphs from the edit on, plus the new ones.

The next document comes by one shuffle of the texts: ids are dealt to partitions by
their quantiles (an id with many rows has partitions of its own, salted), each
partition is read in falling order of id and so has the next document at hand; it
also gets the first document of the partition above, its guest.

Defined cases: a null text is empty; the empty text is one empty paragraph; a null
``doc_id`` comes after all others; rows that share an id have the same next document,
the first one of the next larger id by code point of its text; after the last id comes
the first, and a table with one id is its own next document; equal sums are alike by 1,
a text without strings and another by 0; an empty table gives no rows.  Ids are numbers.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import running_hash, stored, table

DIGEST_LANES = 32
SKETCH_LANES = 256
GRAM = 12
EDIT_SHARE = 4
#: Bytes hashed at once.
STRETCH = 1 << 18
_LAST = 1.7e308


def _sketch(raw: np.ndarray, cuts: np.ndarray, total: np.ndarray) -> None:
    """Adds the sketch of paragraphs raw[cuts[i]:cuts[i + 1] - 1] to ``total`` (int64 lanes)."""
    lanes = len(total)
    for lo in range(0, len(raw), STRETCH):
        part = raw[lo:lo + STRETCH + GRAM - 1]
        sums, back = running_hash(part)
        at = np.arange(min(STRETCH, len(part)))
        # strings end at their paragraph's end; those cut short count only where they start the paragraph
        mine = cuts[np.searchsorted(cuts, lo, side="right") - 1:np.searchsorted(cuts, lo + len(part), side="right") + 1]
        number = np.searchsorted(mine, at + lo, side="right") - 1
        start, end = mine[number] - lo, mine[number + 1] - 1 - lo
        size = np.minimum(end - at, GRAM)
        at, size = (x[(size == GRAM) | ((at == start) & (size > 0))] for x in (at, size))
        h = (sums[at + size] - sums[at]) * back[at]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        lane = ((h >> np.uint64(8)) % np.uint64(lanes)).astype(np.int64)
        sign = 1 - 2 * (h & np.uint64(1)).astype(np.int64)
        total += np.bincount(lane, weights=sign, minlength=lanes).astype(np.int64)


def paragraph_sum(raw: bytes, digest_lanes: int = DIGEST_LANES, sketch_lanes: int = SKETCH_LANES) -> np.ndarray:
    """The vector (uint32 lanes) of the paragraphs of ``raw``: the sum of their vectors."""
    parts = raw.split(b"\n")
    drawn = b"".join([hashlib.shake_128(p).digest(4 * digest_lanes) for p in parts])
    exact = np.frombuffer(drawn, "<u4").reshape(len(parts), digest_lanes).sum(axis=0, dtype=np.uint32)
    sketch = np.zeros(sketch_lanes, np.int64)
    if raw:
        cuts = np.cumsum([0] + [len(p) + 1 for p in parts])
        _sketch(np.frombuffer(raw, np.uint8), cuts, sketch)
    return np.concatenate((exact, sketch.astype(np.uint32)))


def likeness(a: np.ndarray, b: np.ndarray, digest_lanes: int = DIGEST_LANES) -> float:
    """1 for equal sums, else the cosine of the sketch lanes, held between 0 and 1."""
    if np.array_equal(a, b):
        return 1.0
    x, y = (v[digest_lanes:].view(np.int32).astype(np.float64) for v in (a, b))
    norm = float(np.sqrt((x @ x) * (y @ y)))
    return min(1.0, max(0.0, float(x @ y) / norm)) if norm else 0.0


def edit(text: str, following: str, share: int = EDIT_SHARE) -> tuple[str, int]:
    """(text with its last len // share characters replaced by the first as many of ``following``, place of the edit)."""
    n = len(text) // share
    return text[:len(text) - n] + following[:n], len(text) - n


def edited_sum(own: np.ndarray, text: str, edited: str, place: int, **lanes) -> np.ndarray:
    """The sum of ``edited``, from the sum of ``text``: the paragraphs from the edit's on are deleted, the new ones inserted."""
    if edited == text:
        return own
    start = text.rfind("\n", 0, place) + 1
    return own - paragraph_sum(text[start:].encode("utf-8", "surrogatepass"), **lanes) + paragraph_sum(edited[start:].encode("utf-8", "surrogatepass"), **lanes)


def _name(v: np.ndarray) -> str:
    return base64.b64encode(v.astype("<u4").tobytes()).decode()


def in_order(docs: DataFrame, partitions: int) -> tuple[DataFrame, int]:
    """``(slot, doc_id, text, guest)`` of ``docs(doc_id, text)``, dealt to slots by id, with the guests of every slot.

    A slot holds a range of ids, or a salted share of the rows of one id; its guest is
    the first document of the next larger id, or of the smallest one.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(_LAST))
    ids = docs.select("doc_id", place.alias("place"))
    shares = [i / partitions for i in range(1, partitions)]
    bounds = ids.agg(F.percentile_approx("place", shares, 20 * partitions)).first()[0] if shares else []
    # a bound that comes several times is an id with as many partitions' worth of rows
    splits, spread = [], {}
    for b in sorted(set(bounds or [])):
        splits.append(b)
        if bounds.count(b) > 1 and (abs(b) < 2.0**53 or b == _LAST):
            spread[b] = bounds.count(b)
            splits.append(float(np.nextafter(b, np.inf)))
    splits = sorted({-np.inf, np.inf, *splits, 0.0})
    salts = [spread.get(b, 1) for b in splits[:-1]]
    first = [0, *np.cumsum(salts).tolist()]
    cut = Bucketizer(splits=[float(s) for s in splits], inputCol="place", outputCol="range")
    # the least id of every range: one row per partition, whatever the table's size
    least = cut.transform(ids).groupBy(F.col("range").cast("int").alias("range")).agg(F.min(F.struct("place", "doc_id")).alias("low")).collect()
    least = sorted((r["range"], r["low"]["doc_id"]) for r in least) if least else []
    kind = docs.schema["doc_id"].dataType.simpleString()
    hosts = [(low, k, slot) for (k, low), host in zip(least, [least[-1], *least[:-1]]) for slot in range(first[host[0]], first[host[0] + 1])] if least else []
    low = spark.createDataFrame(hosts, f"low {kind}, head int, slot int")
    heads = docs.join(F.broadcast(low.select("low").distinct()), F.col("doc_id").eqNullSafe(F.col("low"))).groupBy("low").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text"))
    # written: a few whole texts, each sent to the slots below its range
    heads = stored(heads, "multiset-heads")
    guests = heads.withColumnRenamed("low", "doc_id").join(F.broadcast(low), F.col("doc_id").eqNullSafe(F.col("low")))
    guests = guests.select("slot", "doc_id", "text", F.lit(True).alias("guest"))
    ranged = cut.transform(docs.select("doc_id", "text", place.alias("place"))).withColumn("range", F.col("range").cast("int"))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.get(F.lit(salts), F.col("range")))
    slot = (F.get(F.lit(first), F.col("range")) + salt).cast("int")
    rows = ranged.select(slot.alias("slot"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("guest"))
    return rows.unionByName(guests), first[-1]


def fingerprints(docs: DataFrame, share: int = EDIT_SHARE, digest_lanes: int = DIGEST_LANES, sketch_lanes: int = SKETCH_LANES,
                 partitions: int | None = None) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` per row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    lanes = {"digest_lanes": digest_lanes, "sketch_lanes": sketch_lanes}
    rows, slots = in_order(docs.select("doc_id", "text"), partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionById(slots, F.col("slot")).sortWithinPartitions(F.desc("guest"), F.col("doc_id").desc_nulls_first(), F.desc("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last, above, begun = None, ("", None), ("", None), False
        for b in batches:
            out = []
            for doc_id, text, guest in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if not (begun and not guest and text == last[0]):
                    own = paragraph_sum(text.encode("utf-8", "surrogatepass"), **lanes)
                else:
                    own = last[1]
                if guest or (begun and doc_id != last_id):
                    above = (text, own) if guest else last
                if not guest:
                    changed, at = edit(text, above[0], share)
                    new = edited_sum(own, text, changed, at, **lanes)
                    out.append((len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), _name(own), _name(new),
                                likeness(own, new, digest_lanes), likeness(own, above[1], digest_lanes)))
                    last_id, last, begun = doc_id, (text, own), True
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = list(zip(*out)) if out else [[]] * len(kinds)
            ids = b.column(1).filter(pc.invert(b.column(3)))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                                             names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return dealt.mapInArrow(run, f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double")


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
