"""WARC archives: monolithic gzip normaliser with a sidecar offset index.

``write_archives`` writes one WARC record per page; Spark's gzip text sink makes
each file one whole-file gzip stream, as many crawlers leave them.
``normalise`` inflates each such stream once, in bounded pieces, rewrites every
record as a gzip member of its own and writes a sidecar index next to the
archive: offset, length, type and id of each member.  ``read_records`` takes
the records back by their offsets, one member at a time.

Of records with equal payloads of at least ``min_bytes`` bytes that with the
smallest page id is a ``response``; the others are ``revisit`` records that
name it and hold the HTTP header without the payload.

Archives go through pyarrow's file systems to the session's shared folder; a
file is written under its attempt's name and then moved, so a lost executor's
half-written file is never read.  Archive size is a parameter: memory of a task
is one compressed archive and one record.

Defined cases: a null payload is empty; of repeated rows with the smallest id
every one is a response; a null page id gets a record of its own without id,
is a revisit where an equal payload has an id, and a response otherwise; line
ends and any bytes in a payload are kept; an empty table gives an empty result.
Other columns are ignored (``url``, where there is one, names the target).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raretide.llm.common import scratch, table

ARCHIVE_BYTES = 48 << 20
MIN_BYTES = 0
LEVEL = 6
PIECE = 1 << 20
END = b"\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(digest: Column) -> Column:
    """Bare upper-case base32 of a 40-digit hex string."""
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def with_roles(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to)``; ``refers_to`` is null for responses."""
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select("page_id", url.alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    raw = F.col("payload").cast("binary")
    rows = rows.withColumn("payload_bytes", F.length(raw).cast("long")).withColumn("key", F.unhex(F.sha2(raw, 256)))
    first = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("key").agg(F.min("page_id").alias("first"))
    rows = rows.join(first, "key", "left").withColumn("payload_digest", base32_of_hex(F.sha1(raw)))
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return rows.select("page_id", "url", "payload", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def record_text(roles: DataFrame) -> DataFrame:
    """Column ``value``: the record without the two line ends that close it."""
    crlf, revisit = F.lit("\r\n"), F.col("refers_to").isNotNull()

    def named(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), crlf, crlf)
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]+", "%20")
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(named(F.col("page_id")), F.lit("<urn:page:>"))),
        F.concat(F.lit("WARC-Target-URI: "), target), F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Refers-To: "), named(F.col("refers_to"))),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return roles.select(F.concat(head, crlf, crlf, block).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Monolithic ``.gz`` archives: the partitions of the payload join, cut at about ``archive_bytes`` payload bytes."""
    total, n = pages.agg(F.sum(F.octet_length("html")), F.count("*")).first()
    rows = max(1, archive_bytes * n // max(1, total or 0))
    records = record_text(with_roles(pages, min_bytes))
    records.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", rows).text(path)


def inflated(stream: bytes) -> Iterator[bytes]:
    """The inflated bytes of a gzip file, in pieces; members that follow each other are one stream."""
    at = 0
    while at < len(stream):
        one = zlib.decompressobj(31)
        while not one.eof and at < len(stream):
            piece = one.decompress(stream[at:at + PIECE])
            at += min(PIECE, len(stream) - at)
            yield piece
        if not one.eof:
            raise ValueError("the gzip stream ends too early")
        at -= len(one.unused_data)


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, with the two line ends that close them, from the pieces of an inflated stream."""
    held, need = bytearray(), None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                cut = held.find(END)
                if cut < 0:
                    break
                need = cut + 4 + int(header(bytes(held[:cut]))["content-length"]) + 4
            if len(held) < need:
                break
            if held[need - 4:need] != END:
                raise ValueError("a record is not closed by two line ends")
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


def header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive of ``source`` into ``target``; ``(archive, index, records)`` per archive."""
    base = target.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, stream in zip(b["path"], b["content"]):
                name = path.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt")
                final, at, lines = f"{base}/{name}.warc.gz", 0, []
                files, place = _open(final)
                own = f"{place}.{uuid.uuid4().hex}"
                files.create_dir(place.rsplit("/", 1)[0], recursive=True)
                with files.open_output_stream(own, compression=None) as out:
                    for record in records(inflated(stream)):
                        squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = squeeze.compress(record) + squeeze.flush()
                        head = header(record[:record.index(END)])
                        lines.append(f"{at}\t{len(member)}\t{head['warc-type']}\t{head['warc-record-id']}\n")
                        out.write(member)
                        at += len(member)
                with files.open_output_stream(f"{own}.idx", compression=None) as out:
                    out.write("".join(lines).encode())
                files.move(own, place)
                files.move(f"{own}.idx", f"{place}.idx")
                yield pd.DataFrame({"archive": [final], "index": [f"{final}.idx"], "records": [len(lines)]})

    rows = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.gz").load(source).select("path", "content")
    done = rows.mapInPandas(run, "archive string, index string, records long")
    path = f"{base}-list"
    done.write.parquet(path)
    return spark.read.parquet(path)


def read_records(archives: DataFrame) -> DataFrame:
    """One row per record of ``archives(archive, index)``, each member read by its offset and inflated alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "archive", "offset", "length"]
        for b in batches:
            for archive, index in zip(b["archive"], b["index"]):
                files, place = _open(archive)
                with files.open_input_stream(_open(index)[1], compression=None) as f:
                    lines = f.read().decode().splitlines()
                rows = []
                with files.open_input_file(place) as f:
                    for line in lines:
                        at, size, kind, _ = line.split("\t", 3)
                        f.seek(int(at))
                        record = zlib.decompress(f.read(int(size)), 31)
                        cut = record.index(END)
                        head, block = header(record[:cut]), record[cut + 4:-4]
                        inner = block.index(END)
                        payload, length = block[inner + 4:], int(header(block[:inner])["content-length"])
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"{archive}: the record at {at} differs from its digest")
                        rows.append((_page(head["warc-record-id"]), length, digest, kind, _page(head.get("warc-refers-to")), head["warc-target-uri"], archive, int(at), int(size)))
                frame = pd.DataFrame(rows, columns=columns)
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, offset long, length long"
    # one archive per task, whatever file the list is in
    return archives.select("archive", "index").repartition(max(1, archives.count()), "archive").mapInPandas(run, schema)


def archive_pages(pages: DataFrame, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write, normalise and read back: the records of all pages."""
    spark = pages.sparkSession
    raw, normal = scratch(spark, "warc-raw"), scratch(spark, "warc")
    write_archives(pages, raw, min_bytes, archive_bytes)
    return read_records(normalise(spark, raw, normal))


def op1_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_LETTERS = " || ".join(
    f"substr('{BASE32}', ((('0x' || substr(hex, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INT + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS hex, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM p
"""
