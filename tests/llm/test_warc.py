import base64
import gzip
import hashlib
import random

from raretide.llm import warc
from raretide.llm.common import scratch


def test_round_trip_and_roles(spark):
    rnd = random.Random(6)
    rows = [(i, f"http://x/{i}", "<p>" + "é\r\n\r\n\n" * rnd.randint(0, 50) + str(i % 7) * (i % 3)) for i in range(80)]
    rows += [(100, None, None), (101, "u", ""), (102, "u v", "\r\n\r\nWARC/1.1\r\n"), (103, "u", "x" * 300000), (104, "u", "x" * 300000),
             (3, rows[3][1], rows[3][2]), (None, "u", "x" * 300000), (None, "u", "alone")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, html string, payload int, refers_to string")
    out = warc.archive_pages(df, archive_bytes=4000).collect()
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    want = []
    for i, _, t in rows:
        raw = (t or "").encode()
        ref = first.get(t or "")
        ref = None if ref == i else ref
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if ref is None else "revisit", ref))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    # every member stands alone, and the members in order are the archive
    some = max(out, key=lambda r: r.offset)
    path = some.archive.removeprefix("file:")
    data = open(path, "rb").read()
    assert gzip.decompress(data[some.offset:some.offset + some.length]).startswith(b"WARC/1.1\r\n")
    lines = open(path + ".idx").read().splitlines()
    assert sum(int(x.split("\t")[1]) for x in lines) == len(data)
    assert warc.archive_pages(df.where("false")).count() == 0


def test_small_payloads_stay_responses(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "a" * 50), (4, "a" * 50)], "page_id long, html string")
    out = {r.page_id: r.record_type for r in warc.archive_pages(df, min_bytes=10).collect()}
    assert out == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_streams_of_many_members_and_broken_ones():
    body = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    stream = gzip.compress(body[:10]) + gzip.compress(body[10:] + body)
    assert list(warc.records(warc.inflated(stream))) == [body, body]
    for bad in (gzip.compress(body[:-1]), gzip.compress(body)[:-12]):
        try:
            list(warc.records(warc.inflated(bad)))
        except ValueError:
            continue
        raise AssertionError("a broken archive must raise")
