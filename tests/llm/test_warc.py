from __future__ import annotations

import gzip
import hashlib
import io
import os
import zlib

import pytest

from aerolith.llm import warc as w

BIG = "é" * 600
PAGE_SCHEMA = "page_id long, url string, html string"
EXTRA = [
    (None, None, None),
    (50_001, "http://x/%41\r\nInjected: 1", ""),
    (50_002, "u", BIG),
    (50_003, "u", BIG),
    (None, "u", BIG),
    (50_004, "ü", BIG + "\r\n\r\nWARC/1.1\r\n"),
    (50_005, "s", "x"),
    (50_006, "s", "x"),
    (60_000, "b", "z" * 3_000_000),
    (60_001, "b", "z" * 3_000_000),
    (60_001, "b", "z" * 3_000_000),
    (None, "n", "only nameless pages have this " * 50),
    (None, "n", "only nameless pages have this " * 50),
]


def expected(rows):
    largest: dict[bytes, int] = {}
    for r in rows:
        payload = (r.html or "").encode()
        if len(payload) >= 1000 and r.page_id is not None:
            largest[payload] = max(largest.get(payload, r.page_id), r.page_id)
    out = []
    for r in rows:
        payload = (r.html or "").encode()
        to = largest.get(payload)
        to = None if to == r.page_id else to
        kind = "response" if to is None else "revisit"
        out.append(str((r.page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, to, r.url)))
    return sorted(out)


def test_round_trip_of_all_pages(spark, table):
    pages = table("pages").unionByName(spark.createDataFrame(EXTRA, PAGE_SCHEMA)).withColumn("digest", w.F.lit("mine"))
    assert sorted(str(tuple(r)) for r in w.warc_round_trip(pages).collect()) == expected(pages.collect())


def test_payloads_and_rolling_archives(spark, scratch):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * i) for i in range(40)], PAGE_SCHEMA).coalesce(1)
    archives = w.write_archives(w.mark_revisits(pages), scratch, archive_bytes=1500)
    listed = archives.collect()
    assert len(listed) > 3 and sum(r.n_records for r in listed) == 40
    assert sorted(os.path.join(scratch, f) for f in os.listdir(scratch)) == sorted(r.path for r in listed)
    got = {r.page_id: (r.url, bytes(r.payload).decode()) for r in w.read_archives(archives, scratch).collect()}
    assert got == {i: (f"u{i}", f"page {i} " * i) for i in range(40)}
    with gzip.open(listed[0].path) as f:
        assert f.read().startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_empty_table(spark):
    assert w.warc_round_trip(spark.createDataFrame([], PAGE_SCHEMA)).count() == 0


def member(payload: bytes, digest: str | None = None) -> bytes:
    return w.record_bytes(1, "u", payload, digest or hashlib.sha1(payload).hexdigest(), None)


class Dripping(io.BytesIO):
    """A stream that gives few bytes at a time."""

    def read(self, n=-1):
        return super().read(min(n, 7))


def test_records_of_any_size_read_in_any_steps():
    payloads = [bytes([i % 251]) * (i * 37) for i in range(60)] + [os.urandom(300_000)]
    data = b"".join(member(p) for p in payloads)
    for stream in (io.BytesIO(data), Dripping(data)):
        assert [r.payload for r in w.read_records(stream)] == payloads


@pytest.mark.parametrize(
    "broken",
    [
        member(b"abc" * 100)[:-20],
        member(b"abc" * 100)[:-8] + bytes(8),
        member(b"abc", "0" * 40),
        gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"),
        gzip.compress(gzip.decompress(member(b"abc")).replace(b"Content-Length: 6", b"Content-Length: 5")),
        gzip.compress(gzip.decompress(member(b"abc")) + b"more"),
        b"not gzip",
    ],
)
def test_broken_archives_raise(broken):
    with pytest.raises((ValueError, zlib.error)):
        list(w.read_records(io.BytesIO(broken)))


def foreign(kind, block, **fields):
    lines = [f"WARC-Type: {kind}", "WARC-Record-ID:<urn:uuid:1234>", f"Content-Length:  {len(block)}"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in fields.items()]
    return gzip.compress(("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n")


def test_archives_of_others(spark, scratch):
    body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nthe page"
    sha256 = hashlib.sha256(b"the page").hexdigest()
    records = [
        foreign("warcinfo", b"software: other\r\n", Content_Type="application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n"),
        foreign("response", body, WARC_Target_URI="http://a/\r\n b"),
        foreign("response", body, WARC_Payload_Digest=f"sha-256:{sha256}"),
        foreign("response", body, WARC_Payload_Digest="crc32:00000000"),
        foreign("response", b"no header at all"),
        foreign("revisit", b"HTTP/1.1 304\r\n\r\n", WARC_Payload_Digest="sha1:" + "A" * 32),
        foreign("metadata", b"via: http://b/"),
        foreign("resource", b"just this", Content_Type="text/plain"),
        w.record_bytes(7, "u", b"own", hashlib.sha1(b"own").hexdigest(), None),
    ]
    (path := os.path.join(scratch, "others.warc.gz")) and open(path, "wb").write(b"".join(records))
    rows = w.read_archives(spark.createDataFrame([(path,)], "path string"), scratch).collect()
    got = [(r.page_id, r.record_type, r.payload_bytes, r.payload and bytes(r.payload), r.verified) for r in rows]
    assert got == [
        (None, "response", 8, b"the page", False),
        (None, "response", 8, b"the page", True),
        (None, "response", 8, b"the page", False),
        (None, "response", 16, b"no header at all", False),
        (None, "revisit", None, None, False),
        (None, "resource", 9, b"just this", False),
        (7, "response", 3, b"own", True),
    ]
    assert rows[0].url == "http://a/ b" and rows[1].payload_digest == sha256 and rows[0].payload_digest == hashlib.sha1(b"the page").hexdigest()
    assert rows[0].record_id == "<urn:uuid:1234>" and rows[4].payload_digest == "0" * 40
    broken = foreign("response", body, WARC_Payload_Digest="md5:" + "0" * 32)
    with pytest.raises(ValueError, match="digest"):
        list(w.read_records(io.BytesIO(broken)))
