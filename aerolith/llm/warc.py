"""WARC archives: one gzip member per record, written and read in sequence.

*Writing.* Every task writes archives of its own into a shared folder, under a
unique name that it renames when complete, and reports them; files of failed
or repeated attempts are reported by nobody. Of pages with equal payloads of at
least ``min_revisit_bytes`` the one with the largest ``page_id`` is a
``response`` record, the others are ``revisit`` records that refer to it and
carry no payload. Only (digest, largest id) of repeated payloads is joined back
to the pages, pre-aggregated before its shuffle.

*Reading.* Archives are read in blocks; each member is inflated as its bytes
arrive, the header block ends at the first empty line, the content is framed by
``Content-Length`` and a response's payload is checked against its
``WARC-Payload-Digest``. One record is in memory at a time. A broken frame or a
wrong digest raises, naming the archive.

Archives of others are read too: records of other types (``warcinfo``,
``request``, ``metadata``) are framed and passed over, a payload without a digest
or with one of an unknown kind is given as not verified, and its length is then
counted. A revisit without a stated length has none. Content is taken as sent:
transfer and content encodings are not undone.

Null html is an empty payload and null urls are left out of the record. Null
ids are never referred to; such a page revisits an equal one that has an id.
Pages that share the largest id are all responses. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.session import checkpoint_dir, materialize

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 16
OUT_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CRLF = b"\r\n"
MANIFEST_SCHEMA = "path string, n_records long, n_bytes long"
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary,"
    " record_id string, verified boolean"
)
# Records that stand for a page's content.
KINDS = ("response", "revisit", "resource")


def open_folder(location: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or URI."""
    if re.match(r"file:/", location):
        location = "file:///" + location[5:].lstrip("/")
    return fs.FileSystem.from_uri(location) if "://" in location else (fs.LocalFileSystem(), location)


# --- records -------------------------------------------------------------


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str | None) -> int | None:
    """The page of a record id that ``_record_id`` made; others have none."""
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member. ``digest`` is hex SHA-1 of the payload; a
    revisit (``refers_to``) keeps the digest and length but not the payload."""
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields)
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head.encode("utf-8", "surrogatepass") + CRLF + block + CRLF + CRLF) + deflate.flush()


@dataclass
class Record:
    page_id: int | None
    url: str | None
    record_type: str
    refers_to: int | None
    payload_bytes: int | None
    payload_digest: str | None
    payload: bytes | None
    record_id: str | None = None
    verified: bool = False


class _Member:
    """One gzip member, inflated from a stream as far as it is asked for."""

    def __init__(self, stream, pending: bytes):
        self.stream, self.pending, self.ready = stream, pending, bytearray()
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.pending or self.stream.read(READ_BYTES)
        if not self.inflate.unconsumed_tail:
            self.pending = b""
        if not data:
            raise ValueError("the archive ends inside a record")
        self.ready += self.inflate.decompress(data, READ_BYTES)
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.ready.find(mark, max(seen - len(mark), 0))) < 0:
            seen = len(self.ready)
            if not self._more():
                raise ValueError("a record has no end of its header")
        return self.exactly(at + len(mark))

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("a record is shorter than its Content-Length")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def close(self) -> bytes:
        """Bytes after the member, which must hold nothing more."""
        while self._more():
            pass
        if self.ready:
            raise ValueError("a record is longer than its Content-Length")
        return self.inflate.unused_data


def _fields(head: str) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with white space
    goes on with the one before."""
    lines = re.sub(r"\r\n[ \t]+", " ", head).split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip(" \t") for name, _, value in (line.partition(":") for line in lines[1:] if line)}


def read_records(stream, kinds: tuple[str, ...] = KINDS) -> Iterator[Record]:
    """Records of an archive, one after another; those of other kinds are
    framed and passed over."""
    pending = stream.read(READ_BYTES)
    while pending:
        member = _Member(stream, pending)
        fields = _fields(member.until(CRLF + CRLF).decode("utf-8", "surrogatepass").removesuffix("\r\n\r\n"))
        block = member.exactly(int(fields["content-length"]))
        if member.exactly(4) != CRLF + CRLF:
            raise ValueError("a record does not end where its Content-Length says")
        pending = member.close() or stream.read(READ_BYTES)
        if fields.get("warc-type") in kinds:
            yield _record(fields, block)


def _stated_digest(text: str | None) -> tuple[str, str] | None:
    """``(algorithm, hex)`` of a digest field in base 32 or 16; None if there is
    none or its algorithm is unknown."""
    kind, _, value = (text or "").partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("sha1", "md5", "sha256", "sha512"):
        return None
    size = hashlib.new(kind).digest_size
    if len(value) == 2 * size and re.fullmatch("[0-9A-Fa-f]+", value):
        return kind, value.lower()
    return kind, base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()


def _record(fields: dict[str, str], block: bytes) -> Record:
    kind, stated = fields["warc-type"], _stated_digest(fields.get("warc-payload-digest"))
    size = int(fields["x-payload-length"]) if "x-payload-length" in fields else None
    payload = None
    if kind != "revisit":
        http = kind == "response" and not fields.get("content-type", "application/http").startswith("text/")
        payload = block[block.find(CRLF + CRLF) + 4 :] if http and CRLF + CRLF in block else block
        wrong = stated and hashlib.new(stated[0], payload).hexdigest() != stated[1]
        if wrong or size not in (None, len(payload)):
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
        size = len(payload)
    digest = stated[1] if stated else hashlib.sha1(payload).hexdigest() if payload is not None else None
    url = fields.get("warc-target-uri")
    return Record(
        _page_of(fields.get("warc-record-id")),
        None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        kind,
        _page_of(fields.get("warc-refers-to")),
        size,
        digest,
        payload,
        fields.get("warc-record-id"),
        bool(stated) and payload is not None,
    )


# --- jobs ----------------------------------------------------------------


def mark_revisits(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` of every page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    repeated = (
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy(F.col("digest").alias("repeated_digest"))
        .agg(F.count("*").alias("n"), F.max("page_id").alias("largest"))
        .where((F.col("n") > 1) & F.col("largest").isNotNull())
        .drop("n")
    )
    joined = rows.join(repeated, F.col("digest") == F.col("repeated_digest"), "left")
    others = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "payload", "digest", F.when(others, F.col("largest")).alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``marked`` into ``folder``. The result lists the
    archives; it is written itself, so nothing is archived twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        store.create_dir(base, recursive=True)
        stem = f"{base}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        out, number, counts = None, 0, [0, 0]

        def closed() -> pa.RecordBatch:
            out.close()
            store.move(f"{stem}-{number}.open", path := f"{stem}-{number}.warc.gz")
            row = {"path": [path], "n_records": [counts[0]], "n_bytes": [counts[1]]}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*batch.columns):
                record = record_bytes(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py())
                if out is None:
                    out, counts = store.open_output_stream(f"{stem}-{number}.open", compression=None), [0, 0]
                out.write(record)
                counts[0] += 1
                counts[1] += len(record)
                if counts[1] >= archive_bytes:
                    yield closed()
                    out, number = None, number + 1
        if out is not None:
            yield closed()

    return materialize(marked.mapInArrow(run, MANIFEST_SCHEMA), "archives")


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the listed archives (``path``, in the store of ``folder``),
    a task per share of the archives."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        + [("record_id", pa.string()), ("verified", pa.bool_())]
    )

    def batch_of(rows: list[Record]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([getattr(r, f.name) for r in rows], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    try:
                        for record in read_records(stream):
                            if not with_payload:
                                record.payload = None
                            rows.append(record)
                            size += len(record.payload or b"") + 256
                            if size >= OUT_BYTES:
                                yield batch_of(rows)
                                rows, size = [], 0
                    except (ValueError, KeyError, zlib.error) as broken:
                        raise ValueError(f"{path}: {broken}") from broken
                yield batch_of(rows)

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(n).mapInArrow(run, RECORD_SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages into archives in the shared folder and read them back."""
    folder = f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    archives = write_archives(mark_revisits(pages), folder)
    records = read_archives(archives, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
