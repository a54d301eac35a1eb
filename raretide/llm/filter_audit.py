"""Which filter removes what: an audit of five text filters under every order.

A text fails A with too few words, B with too few distinct ones, C with too many
capitals, D with a symbol, E when it equals the text of a smaller id.  Each text is
read once by a byte transducer: the table gives, for the state before a byte (outside
or inside a word) and the byte's class, the next state and what the byte adds: a word's
start or end, a capital, a code point, a symbol.  The state after a byte depends on its
class alone, so a whole block of texts runs by table lookup.  The spans between word
starts and ends go into an open-addressed hash table that counts a span as known only
when its bytes equal a member's; a block holds many short texts or a stretch of a long
one, whose table lives on to its end.

What remains of a document is a few numbers and the digest of its text.  They are
counted by part and combination of failures (32 at most); every order and step is a sum
over these combinations, so the 120 orders never meet the documents.

Defined cases: a null text is empty (fails A; also E when another empty text has a
smaller id); a null source is the empty part, together with the empty source; a document
without id is never a smaller one and does not fail E; rows that share an id do not make
each other fail E; a document is good (toxic) when any of its label rows says so;
documents without label rows are neither; an empty table gives no rows.  Texts are
identical when length and SHA-256 are.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import hash_power, running_hash, stored, table

FILTERS = "ABCDE"
MIN_WORDS = 200
#: Least distinct words and most capitals, in hundredths of the words and code points.
MIN_DISTINCT = 50
MAX_CAPITALS = 2
SYMBOLS = b"#$%&*|"
BLOCK = 1 << 20

_SPACE, _CAPITAL, _SYMBOL, _PLAIN, _LEAD, _MORE = range(6)
_OUTSIDE, _INSIDE = range(2)
#: What a byte adds, one bit each.
STARTS, ENDS, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8, 16


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of every byte, next state by class, output by state and class)."""
    kind = np.full(256, _PLAIN, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = _SPACE
    kind[0x41:0x5B] = _CAPITAL
    kind[list(SYMBOLS)] = _SYMBOL
    kind[0x80:0xC0] = _MORE
    kind[0xC0:] = _LEAD
    follow = np.array([_OUTSIDE if k == _SPACE else _INSIDE for k in range(6)], np.uint8)
    output = np.zeros((2, 6), np.uint8)
    output[_OUTSIDE, 1:] |= STARTS
    output[_INSIDE, _SPACE] |= ENDS
    output[:, _CAPITAL] |= CAPITAL
    output[:, _SYMBOL] |= SYMBOL
    output[:, :_MORE] |= POINT
    return kind, follow, output


KIND, FOLLOW, OUTPUT = _tables()


class WordTable:
    """Open-addressed set of spans of one byte buffer, each with an owner; equal spans of one owner are one member."""

    def __init__(self, raw: np.ndarray):
        self.raw = raw
        self.keys = np.zeros(0, np.uint64)
        self.spans = np.zeros((3, 0), np.int64)  # start, size, owner
        self.slots = np.full(1 << 10, -1, np.int64)

    def _equal(self, spans: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a and b, of equal size, have equal bytes."""
        size = spans[1][a]
        ends = np.cumsum(size)
        if not len(ends):
            return np.zeros(0, bool)
        at = np.arange(ends[-1]) + np.repeat(spans[0][a] - (ends - size), size)
        other = at + np.repeat(spans[0][b] - spans[0][a], size)
        return np.logical_and.reduceat(self.raw[at] == self.raw[other], ends - size)

    def insert(self, keys: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Marks the spans (start, size, owner by row) that were not members yet; size is 1 at least."""
        held = len(self.keys)
        every, spans = np.concatenate((self.keys, keys)), np.concatenate((self.spans, spans), axis=1)
        if len(every) * 2 > len(self.slots):
            self.slots = np.full(1 << (2 * len(every)).bit_length(), -1, np.int64)
            self._place(np.arange(held), every, None)
        fresh = np.zeros(len(every), bool)
        fresh[self._place(np.arange(held, len(every)), every, spans)] = True
        # members keep the order in which they came
        number = np.cumsum(fresh[held:]) + held - 1
        new = np.flatnonzero(self.slots >= held)
        self.slots[new] = number[self.slots[new] - held]
        keep = np.concatenate((np.arange(held), held + np.flatnonzero(fresh[held:])))
        self.keys, self.spans = every[keep], spans[:, keep]
        return fresh[held:]

    def _place(self, waiting: np.ndarray, keys: np.ndarray, spans: np.ndarray | None) -> np.ndarray:
        """Puts the waiting numbers in slots, probing on; returns those that became members (spans None: all are distinct)."""
        mask = len(self.slots) - 1
        slot = (keys[waiting] >> np.uint64(20)).astype(np.int64) & mask
        members = []
        while len(waiting):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = waiting[free]
            holder = self.slots[slot]
            on = holder != waiting
            members.append(waiting[~on])
            if spans is not None:
                like = np.flatnonzero(on & (keys[waiting] == keys[holder]) & (spans[1:, waiting] == spans[1:, holder]).all(axis=0))
                on[like[self._equal(spans, waiting[like], holder[like])]] = False
            waiting, slot = waiting[on], (slot[on] + 1) & mask
        return np.concatenate(members) if members else waiting


def span_keys(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit keys of spans with the given hashes and owners."""
    key = hashes + owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(32))


def _read(raw: np.ndarray, lo: int, hi: int, edges: np.ndarray, words: WordTable, out: np.ndarray,
          carried: tuple[int, int] | None = None, closed: bool = True) -> tuple[int, int] | None:
    """Runs the transducer over raw[lo:hi], whose documents begin at ``edges``; adds to their rows of ``out``.

    ``carried`` is the (start, hash) of a word that the bytes before left open; unless
    ``closed``, a word that reaches the end is left open and returned.
    """
    block = raw[lo:hi]
    kind = KIND[block]
    state = np.empty(len(block), np.uint8)
    state[1:] = FOLLOW[kind[:-1]]
    state[0] = _INSIDE if carried else _OUTSIDE
    begin = edges[edges < hi] - lo  # below 0 for a document that began in an earlier block
    state[begin[begin > 0]] = _OUTSIDE
    given = OUTPUT[state, kind]
    starts = np.flatnonzero(given & STARTS)
    # a word ends at a space after it, or where its document ends
    cuts = np.unique(np.concatenate((begin[begin > 0], [len(block)])))
    cuts = cuts[FOLLOW[kind[cuts - 1]] == _INSIDE]
    ends = np.sort(np.concatenate((np.flatnonzero(given & ENDS), cuts)))
    sums, back = running_hash(block)
    starts = np.concatenate(([0], starts)) if carried else starts
    hashes = (sums[ends] - sums[starts]) * back[starts]
    begins = starts + lo
    if carried:
        begins[0] = carried[0]
        hashes[0] = (carried[1] + int(hashes[0]) * hash_power(lo - carried[0])) % (1 << 64)
    left = None
    if not closed and len(ends) and ends[-1] == len(block):
        left = int(begins[-1]), int(hashes[-1])
        begins, ends, hashes = begins[:-1], ends[:-1], hashes[:-1]
    owners = np.searchsorted(edges, begins, side="right") - 1
    fresh = words.insert(span_keys(hashes, owners), np.stack((begins, ends + lo - begins, owners)))
    rows = len(out)
    out[:, 0] += np.bincount(owners, minlength=rows)
    out[:, 1] += np.bincount(owners[fresh], minlength=rows)
    for column, bit in ((2, CAPITAL), (4, SYMBOL)):
        out[:, column] += np.bincount(np.searchsorted(edges, np.flatnonzero(given & bit) + lo, side="right") - 1, minlength=rows)
    points = np.concatenate(([0], np.cumsum((given & POINT) != 0)))
    bounds = np.clip(np.concatenate((edges, [hi])) - lo, 0, len(block))
    out[:, 3] += np.diff(points[bounds])
    return left


def measure(raw: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """(words, distinct words, capitals, code points, symbols) of the texts raw[offsets[i]:offsets[i + 1]]."""
    n = len(offsets) - 1
    out = np.zeros((n, 5), np.int64)
    i = 0
    while i < n:
        # as many whole documents as fit into a block, or one long document in stretches
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block, side="right")) - 1)
        lo, end, words, carried, own = int(offsets[i]), int(offsets[j]), WordTable(raw), None, out[i:j]
        while lo < end:
            hi = min(end, lo + block)
            carried = _read(raw, lo, hi, offsets[i:j], words, own, carried, hi == end)
            lo = hi
        i = j
    return out


def judged(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, source, n_bytes, digest, fails)`` per row of ``docs(doc_id, source, text)``; a bit each for A to D."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(2).cast(pa.large_binary()).fill_null(b"")
            _, ends, data = text.buffers()
            offsets = np.frombuffer(ends, np.int64)[text.offset:text.offset + len(text) + 1]
            raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            words, distinct, capitals, points, symbols = measure(raw, offsets, block).T
            fails = ((words < MIN_WORDS) + 2 * (100 * distinct < MIN_DISTINCT * words) + 4 * (100 * capitals > MAX_CAPITALS * points)
                     + 8 * (symbols > 0)).astype(np.int32)
            digests = [hashlib.sha256(raw[a:z]).digest() for a, z in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(offsets)), pa.array(digests, pa.binary()), pa.array(fails)],
                                             names=["doc_id", "source", "n_bytes", "digest", "fails"])

    return docs.select("doc_id", "source", "text").mapInArrow(run, f"doc_id {kind}, source string, n_bytes long, digest binary, fails int")


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with E's bit where a smaller id has an identical text."""
    low = rows.groupBy("digest", "n_bytes").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).where("n > 1")
    # written first: the join has plain shuffles on either side then, so AQE splits a text with many copies
    low = stored(low.select(F.col("digest").alias("d"), F.col("n_bytes").alias("b"), "low"), "audit-copies")
    joined = rows.join(low, (F.col("digest") == F.col("d")) & (F.col("n_bytes") == F.col("b")), "left")
    copy = F.coalesce(F.col("low") < F.col("doc_id"), F.lit(False)).cast("int")
    return joined.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), (F.col("fails") + 16 * copy).alias("fails"))


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before, bit of the filter) of every order and step."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            out.append((name, step, before, 1 << f))
            before |= 1 << f
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; see the module and the query's contract for the columns."""
    rows = stored(with_copies(stored(judged(docs), "audit-rows")), "audit-fails")
    zero = F.lit(0).cast("long")
    counted = rows.groupBy("part", "fails").agg(F.count("*").alias("n")).select("part", "fails", "n", zero.alias("good"), zero.alias("toxic"))
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("l")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    marked = rows.join(said, F.col("doc_id") == F.col("l")).groupBy("part", "fails").agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    marked = marked.select("part", "fails", zero.alias("n"), "good", "toxic")
    both = counted.unionByName(marked).groupBy("part", "fails").agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("n", "good", "toxic")])
    parts = both.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))  # 32 sets at most

    def total(keep, column: str) -> Column:
        return F.aggregate("sets", F.lit(0).cast("long"), lambda t, s: t + F.when(keep(s["fails"]), s[column]).otherwise(0))

    def clear(fails: Column, bits: Column) -> Column:
        return fails.bitwiseAND(bits) == 0

    steps = _steps()
    kinds = sorted({(before, bit) for _, _, before, bit in steps})

    def sums(k: Column) -> Column:
        before, bit = k["before"], k["bit"]
        first = lambda f: clear(f, before) & ~clear(f, bit)
        return F.struct(
            total(lambda f: clear(f, before) & clear(f, bit), "n").alias("kept"), total(first, "n").alias("removed"),
            total(lambda f: ~clear(f, before) & ~clear(f, bit), "n").alias("redundant"), total(lambda f: f == bit, "n").alias("unique_fails"),
            total(first, "good").alias("good_lost"), total(first, "toxic").alias("toxic_lost"))

    given = F.arrays_zip(F.lit([b for b, _ in kinds]).alias("before"), F.lit([f for _, f in kinds]).alias("bit"))
    parts = parts.select("part", F.transform(given, sums).alias("cells"))
    # a filter comes directly after a given set of others in |set|! (4 - |set|)! orders
    most = len(FILTERS) - 1
    share = [sum((F.get("cells", F.lit(i))["removed"] * (factorial(b.bit_count()) * factorial(most - b.bit_count())) for i, (b, g) in enumerate(kinds) if g == 1 << f), zero)
             for f in range(len(FILTERS))]
    parts = parts.select("part", "cells", F.array(*share).alias("shapley"))
    asked = F.arrays_zip(F.lit([s[0] for s in steps]).alias("filter_order"), F.lit([s[1] for s in steps]).alias("step"),
                         F.lit([kinds.index(s[2:]) for s in steps]).alias("cell"), F.lit([s[3].bit_length() - 1 for s in steps]).alias("filter"))
    out = parts.select("part", "cells", "shapley", F.explode(asked).alias("a"))
    cell = F.get("cells", F.col("a.cell"))
    return out.select("part", "a.filter_order", F.col("a.step").cast("int").alias("step"),
                      *[cell[c].alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")],
                      F.get("shapley", F.col("a.filter")).alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
f AS (SELECT doc_id, part,
        CASE WHEN len(ws) < {MIN_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < {MIN_DISTINCT} * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN low < doc_id THEN 16 ELSE 0 END AS fails FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM k a, k b, k c, k d, k e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
