"""Exact repeated-string removal with suffix arrays over shards.

A byte goes when it lies in a string of ``length`` bytes that also starts
anywhere else in the corpus, the same document included.  The work is narrowed
in steps that lose nothing, and decided by suffix arrays:

1. Equal texts are one text; a text with a copy goes whole (if long enough).
2. Anchors: of the hashes of all ``GRAM``-byte strings inside a window of
   ``length`` bytes the least is the window's anchor, so equal windows have
   equal anchors.  Windows whose anchor occurs once in the corpus are unique.
3. The other stretches are cut at content-defined anchors into pieces.  Equal
   pieces are one piece, counted: their windows repeat.
4. The distinct pieces go to shards by their least anchor, so that variants of
   one stretch meet; an anchor with more bytes than a shard holds is spread over
   several.  Each shard builds its suffix array
   by Larsson-Sadakane refinement (prefix doubling that touches only groups
   not yet told apart) and the common prefixes by Kasai's scan, run in lockstep
   over stretches of the text.  Neighbours with ``length`` common bytes repeat.
5. Windows whose anchor is in several shards are merged across them: each shard
   ships one 64-bit key per distinct window, sorted; binary search for the range
   ends cuts its run into merge ranges, and in a range every run is searched in
   the merged runs: a key of two shards repeats in both.

Windows enter the merge once per shard however often they occur, so a passage
that many documents share is a few rows.  Sizes of shards and ranges are
parameters; nothing depends on the number of copies.

Defined cases: a null text is empty; texts shorter than ``length`` keep all; a
null or repeated ``doc_id`` keeps its rows; an empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import stored, table

LENGTH = 400
GRAM = 128
SHARD_BYTES = 1 << 20
RANGE_KEYS = 1 << 20
CUT_EVERY = 16
#: Bytes of a SHA-256 that name a text or a piece.
KEY_BYTES = 14
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.full(size, _BASE, dtype=np.uint64)
    back = np.full(size, _INVERSE, dtype=np.uint64)
    one[0] = back[0] = 1
    return np.multiply.accumulate(one), np.multiply.accumulate(back)


def window_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width``-byte string of ``raw`` (uint8)."""
    up, down = _powers(1 << max(16, (len(raw)).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[:len(raw)], dtype=np.uint64)))
    x = (sums[width:] - sums[:-width]) * down[:len(raw) - width + 1]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding(x: np.ndarray, width: int, op: np.ufunc, pad: int) -> np.ndarray:
    """``op`` (minimum or maximum) over every ``width`` neighbours, from running results within blocks."""
    n = len(x)
    rows = np.concatenate((x, np.full(-n % width, pad, dtype=x.dtype))).reshape(-1, width)
    ahead = op.accumulate(rows, axis=1).ravel()
    back = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n - width + 1], ahead[width - 1:n])


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor of every window, places of anchors, their hashes)."""
    h = window_hashes(raw, gram)
    width = length - gram + 1
    least = sliding(h, width, np.minimum, (1 << 64) - 1)
    edge = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate((edge, least, edge)), width, np.maximum, 0)
    places = np.flatnonzero(most == h)
    return least, places, h[places]


def suffix_array(raw: np.ndarray) -> np.ndarray:
    """Suffix array by Larsson-Sadakane refinement: sort by 7 bytes, then double, within unsorted groups only."""
    n = len(raw)
    padded = np.concatenate((raw.astype(np.int64) + 1, np.zeros(8, np.int64)))
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = key * 257 + padded[i:i + n]
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(np.concatenate((heads, [n])))
    rank = np.empty(n + 1, np.int64)  # a group's number is the place of its first suffix
    rank[n] = -1
    rank[sa] = np.repeat(heads, sizes)
    spots = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places of the array that are not sorted yet
    h = 7
    while len(spots) and h < 2 * n:
        suffixes = sa[spots]
        key = rank[suffixes] * (n + 2) + rank[np.minimum(suffixes + h, n)] + 1
        order = np.argsort(key, kind="stable")
        suffixes, key = suffixes[order], key[order]
        sa[spots] = suffixes
        new = np.concatenate(([True], key[1:] != key[:-1]))
        heads = np.flatnonzero(new)
        sizes = np.diff(np.concatenate((heads, [len(spots)])))
        rank[suffixes] = np.repeat(spots[heads], sizes)
        spots = spots[np.repeat(sizes > 1, sizes)]
        h *= 2
    return sa


def common_prefixes(raw: np.ndarray, sa: np.ndarray, limit: int, stretches: int = 4096) -> np.ndarray:
    """Kasai's common prefix (up to ``limit``) of each suffix of the array with the one before it."""
    n = len(raw)
    before = np.empty(n, np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate((raw, np.zeros(limit + 1, np.uint8)))
    step = -(-n // stretches)
    at = np.arange(0, n, step)
    end = np.minimum(at + step, n)
    got = np.zeros(len(at), np.int64)
    out = np.zeros(n, np.int64)
    while len(at):
        # every stretch compares one byte or moves on to its next suffix, which has one byte less in common at least
        other = before[at]
        far = np.maximum(at, other) + got
        more = (other >= 0) & (got < limit) & (far < n) & (padded[at + got] == padded[np.maximum(other, 0) + got])
        got += more
        move = ~more
        out[at[move]] = got[move]
        at = at + move
        got = np.where(move, np.maximum(got - 1, 0), got)
        if move.any():
            live = at < end
            if not live.all():
                at, end, got = at[live], end[live], got[live]
    return out[sa]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def text_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``(doc_id, full, sha, n_bytes, hashes, counts)`` per row of ``docs(doc_id, text)``; ``sha`` is the short key."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                raw = _raw(text)
                values = counts = np.zeros(0, np.int64)
                if len(raw) >= length:
                    values, counts = np.unique(anchors(raw, length, gram)[2].view(np.int64), return_counts=True)
                digest = hashlib.sha256(raw)
                rows.append((doc_id, digest.hexdigest(), digest.digest()[:KEY_BYTES], len(raw), values, counts))
            out = pd.DataFrame(rows, columns=["doc_id", "full", "sha", "n_bytes", "hashes", "counts"])
            out["doc_id"] = b["doc_id"].to_numpy()
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, full string, sha binary, n_bytes long, hashes array<long>, counts array<long>")


def pieces_of(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(sha, at, starts, piece, marks, body)``, ``marks`` the anchors of its windows, of the stretches of ``texts(sha, text, wanted)`` whose windows have wanted anchors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for sha, text, wanted in zip(b["sha"], b["text"], b["wanted"]):
                raw = _raw(text)
                least, places, hashes = anchors(raw, length, gram)
                first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
                hit = np.isin(least[first].view(np.int64), np.asarray(wanted))
                flags = np.repeat(hit, np.diff(np.concatenate((first, [len(least)]))))
                cuts = places[hashes % np.uint64(CUT_EVERY) == 0]
                for lo, hi in zip(*runs(flags)):
                    inner = cuts[np.searchsorted(cuts, lo, "right"):np.searchsorted(cuts, hi)]
                    edges = [int(lo), *inner.tolist(), int(hi)]
                    for a, z in zip(edges, edges[1:]):
                        body = raw[a:z + length - 1].tobytes()
                        marks = np.unique(least[a:z].view(np.int64))
                        rows.append((sha, a, z - a, hashlib.sha256(body).digest()[:KEY_BYTES], marks, body))
            yield pd.DataFrame(rows, columns=["sha", "at", "starts", "piece", "marks", "body"])

    return texts.mapInPandas(run, "sha binary, at long, starts long, piece binary, marks array<long>, body binary")


def shard_runs(pieces: DataFrame, length: int, gram: int, ranges: int) -> DataFrame:
    """Suffix arrays of ``pieces(shard, piece, shared, body)``; ``shared`` are its anchors that other shards have.

    Rows with range -1 hold the shard's pieces and the windows that repeat inside
    it (one bit per byte of the joined bodies); the others hold one merge range of
    the shard's sorted window keys and the windows' places.
    """
    width = (1 << 64) // ranges
    ends = np.array([i * width for i in range(1, ranges)], dtype=np.uint64)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("piece").sort_values("piece")
        shard, bodies = int(group["shard"].iloc[0]), list(group["body"])
        raw = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        sizes = np.array([len(x) for x in bodies])
        valid = np.ones(len(raw), dtype=bool)
        for end in np.cumsum(sizes):
            valid[end - length + 1:end] = False
        sa = suffix_array(raw)
        prefix = common_prefixes(raw, sa, length)
        # windows that share `length` bytes are neighbours: a class is a run of such neighbours
        kind = np.cumsum(prefix < length) - 1
        good = valid[sa]
        many = np.bincount(kind[good], minlength=kind[-1] + 1)
        flags = np.zeros(len(raw), dtype=bool)
        flags[sa[good & (many[kind] > 1)]] = True
        # one window of each class that other shards may have goes into the shard's run
        shared = np.unique(np.concatenate([np.asarray(x, dtype=np.int64) for x in group["shared"]]))
        abroad = np.isin(anchors(raw, length, gram)[0].view(np.int64), shared) if len(shared) else np.zeros(len(raw) - length + 1, bool)
        good &= np.concatenate((abroad, np.zeros(length - 1, bool)))[sa]
        own, one = np.unique(kind[good], return_index=True)
        place = sa[good][one]
        keys = window_hashes(raw, length)[place]
        order = np.argsort(keys, kind="stable")
        keys, place = keys[order], place[order]
        # a class of several windows is decided here; its place is sent as none
        lone = many[own][order] == 1
        cut = np.concatenate(([0], np.searchsorted(keys, ends), [len(keys)]))
        rows = [(shard, -1, list(group["piece"]), sizes.tolist(), np.packbits(flags).tobytes(), b"")]
        for r in range(ranges):
            a, z = cut[r], cut[r + 1]
            if z > a:
                where = np.where(lone[a:z], place[a:z], -1).astype(np.int32)
                rows.append((shard, r, None, None, keys[a:z].tobytes(), where.tobytes()))
        return pd.DataFrame(rows, columns=["shard", "range", "names", "sizes", "data", "places"])

    schema = "shard int, range int, names array<binary>, sizes array<long>, data binary, places binary"
    return pieces.groupBy("shard").applyInPandas(run, schema)


def merged(parts: DataFrame) -> DataFrame:
    """``(shard, found)``: places of windows whose key is in another shard's run of the same range."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(x, np.uint64) for x in group["data"]]
        every = np.sort(np.concatenate(own), kind="stable")
        rows = []
        for shard, keys, places in zip(group["shard"], own, group["places"]):
            # a shard sends a key once, so a key that spans two places of the merged run is another shard's too
            twice = np.searchsorted(every, keys, "right") - np.searchsorted(every, keys, "left") > 1
            place = np.frombuffer(places, np.int32)[twice]
            place = np.sort(place[place >= 0])
            if len(place):
                rows.append((shard, place.tobytes()))
        return pd.DataFrame(rows, columns=["shard", "found"])

    return parts.groupBy("range").applyInPandas(run, "shard int, found binary")


def repeated_starts(parts: DataFrame) -> DataFrame:
    """``(piece, lo, hi)``: runs of window starts of each piece that repeat (relative to the piece)."""
    local, sent = parts.where("range < 0"), merged(parts.where("range >= 0"))

    def run(mine: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for names, sizes, data in zip(mine["names"], mine["sizes"], mine["data"]):
            ends = np.cumsum(sizes)
            flags = np.unpackbits(np.frombuffer(data, np.uint8), count=int(ends[-1])).astype(bool)
            for x in found["found"]:
                flags[np.frombuffer(x, np.int32)] = True
            for name, end, size in zip(names, ends, sizes):
                lo, hi = runs(flags[end - size:end])
                rows.append((name, lo.tolist(), hi.tolist()))
        return pd.DataFrame(rows, columns=["piece", "lo", "hi"])

    return local.groupBy("shard").cogroup(sent.groupBy("shard")).applyInPandas(run, "piece binary, lo array<long>, hi array<long>")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` per row of ``docs(doc_id, text)``.

    ``spans`` are the removed byte ranges ``(lo, hi)`` of the text.
    """
    gram = min(gram, length)
    rows = stored(text_anchors(docs, length, gram), "suffix-anchors")
    texts = rows.groupBy("sha").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.first("full").alias("full"))
    texts = stored(texts, "suffix-texts")
    # anchors that occur twice in the distinct texts
    once = rows.where(F.size("hashes") > 0).join(
        texts.select("sha", "doc_id"), (rows["sha"] == texts["sha"]) & rows["doc_id"].eqNullSafe(texts["doc_id"]), "left_semi")
    once = once.select("sha", "hashes", "counts").dropDuplicates(["sha"])
    once = once.select("sha", F.explode(F.arrays_zip("hashes", "counts")).alias("x")).select("sha", F.col("x.hashes").alias("hash"), F.col("x.counts").alias("n"))
    once = stored(once, "suffix-hashes")
    often = once.groupBy("hash").agg(F.sum("n").alias("all")).where("all > 1").select("hash")
    often = stored(often, "suffix-often")
    wanted = once.select("sha", "hash").join(often, "hash").groupBy("sha").agg(F.collect_list("hash").alias("wanted"))
    wanted = stored(wanted.join(texts.select("sha", F.col("doc_id").alias("rep")), "sha"), "suffix-wanted")
    # the text of one row per wanted text; the id in the key spreads the copies
    source = docs.select("doc_id", "text", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, KEY_BYTES).alias("s"))
    picked = source.join(wanted, (F.col("s") == F.col("sha")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("sha", "text", "wanted")
    picked = stored(picked, "suffix-picked")  # repeated rows of one id stay repeated here
    pieces = stored(pieces_of(picked, length, gram), "suffix-pieces")
    spots = pieces.select("sha", "at", "starts", "piece", "marks").dropDuplicates(["sha", "at"])
    spots = stored(spots, "suffix-spots")
    distinct = spots.groupBy("piece").agg(F.count("*").alias("times"), F.min(F.struct("sha", "at")).alias("one"), F.first("marks").alias("marks"), F.first("starts").alias("n"))
    distinct = stored(distinct.withColumn("mark", F.array_min("marks")), "suffix-distinct")
    # shards by least anchor; one with many bytes is spread by the pieces' hash
    load = distinct.groupBy("mark").agg(F.sum(F.col("n") + (length - 1)).alias("bytes"))
    load = stored(load.withColumn("spread", F.ceil(F.col("bytes") / shard_bytes)), "suffix-load")
    size = load.agg(F.sum("bytes")).first()[0] or 0
    shards, ranges = max(1, -(-int(size) // shard_bytes)), max(1, -(-int(size) // range_keys))
    salted = distinct.join(load.select(F.col("mark").alias("m"), "spread"), F.col("mark") == F.col("m"))
    shard = F.pmod(F.xxhash64("mark", F.pmod(F.xxhash64("piece"), F.col("spread"))), F.lit(shards)).cast("int")
    placed = stored(salted.select("piece", "one", "marks", shard.alias("shard")), "suffix-placed")
    marks = placed.select("piece", "shard", F.explode("marks").alias("mark"))
    shared = marks.groupBy("mark").agg(F.min("shard").alias("a"), F.max("shard").alias("z")).where("a < z").select("mark")
    shared = marks.join(stored(shared, "suffix-shared"), "mark").groupBy("piece").agg(F.collect_list("mark").alias("shared"))
    placed = placed.select(F.col("piece").alias("p"), "one", "shard").join(shared.withColumnRenamed("piece", "q"), F.col("p") == F.col("q"), "left")
    placed = placed.select("p", F.col("one.sha").alias("t"), F.col("one.at").alias("a"), "shard", F.coalesce("shared", F.array().cast("array<long>")).alias("shared"))
    bodies = pieces.select("sha", "at", "piece", "body").join(placed, (F.col("sha") == F.col("t")) & (F.col("at") == F.col("a"))).select("shard", "piece", "shared", "body")
    parts = stored(shard_runs(bodies, length, gram, ranges), "suffix-runs")
    found = stored(repeated_starts(parts), "suffix-found")
    # a piece with equals repeats whole; of the others, the starts found
    known = distinct.select("piece", "times").join(found, "piece", "left")
    spots = spots.select("sha", "at", "starts", "piece").join(known, "piece")
    whole = F.array(F.struct(F.col("at").alias("lo"), (F.col("at") + F.col("starts") - 1 + length).alias("hi")))
    part = F.zip_with("lo", "hi", lambda a, z: F.struct((F.col("at") + a).alias("lo"), (F.col("at") + z - 1 + length).alias("hi")))
    spots = spots.select("sha", F.explode(F.when(F.col("times") > 1, whole).otherwise(part)).alias("span"))
    spans = spots.groupBy("sha").agg(F.sort_array(F.collect_list("span")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for sha, text, marks in zip(b["sha"], b["text"], b["spans"]):
                raw = _raw(text)
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, [m["lo"] for m in marks], 1)
                np.add.at(edge, [m["hi"] for m in marks], -1)
                gone = np.cumsum(edge[:-1]) > 0
                lo, hi = runs(gone)
                out.append((sha, int(gone.sum()), len(lo), hashlib.sha256(raw[~gone]).hexdigest(), [{"lo": int(a), "hi": int(z)} for a, z in zip(lo, hi)]))
            yield pd.DataFrame(out, columns=["sha", "n_removed", "n_spans", "kept_sha256", "spans"])

    done = picked.select("sha", "text").join(spans, "sha").mapInPandas(cut, "sha binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<lo:long,hi:long>>").dropDuplicates(["sha"])
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    verdict = texts.select("sha", "full", "copies", "n_bytes").join(done, "sha", "left").select(
        "sha",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "full")).alias("kept_sha256"),
        F.when(copied, F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("n_bytes").alias("hi")))).otherwise(
            F.coalesce("spans", F.array().cast("array<struct<lo:long,hi:long>>"))).alias("spans"),
    )
    # written first: both sides of the join are plain shuffles then, and AQE splits a text with many copies
    verdict = stored(verdict, "suffix-verdict")
    return rows.select("doc_id", "sha", "n_bytes").join(verdict, "sha").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def op2_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
