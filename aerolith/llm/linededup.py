"""Removal of lines that many documents repeat, by two Bloom filters.

A line's *key* is the line with ASCII white space stripped at both ends and
A-Z lower-cased. A key of at least ``min_chars`` code points found in at least
``min_docs`` documents loses all its lines, except those of the document with
the largest ``doc_id`` that holds it.

1. Every task adds its documents' keys to a *once* filter; a key whose bits are
   all set already goes to a *twice* filter too. The filters leave the task as
   compressed segments and are merged per segment: ``once`` by OR; ``twice`` by
   OR together with the bits that two ``once`` filters share. No line moves.
2. Only keys the merged *twice* filter may hold are shuffled. A filter has no
   false negatives, so every repeated key is among them.
3. The suspects are confirmed exactly, by the key itself: distinct documents
   are counted in two steps (key and document, then key), so one key in a third
   of all rows is summed before it meets, and the largest ``doc_id`` is kept.

The filter is sized by a sketch of the number of distinct lines, some 16 bits
each, which keeps false suspects under 2 %. It is broadcast, so it never exceeds
``MOST_FILTER_BITS``; beyond that capacity more lines become suspects and are
shuffled, and the result never changes.

Null text counts as one empty line and stays null. Rows that share a ``doc_id``
are one document. Rows without ``doc_id`` count for no key and lose every
repeated line; each is taken by its own text, so they never meet. Other columns
are passed through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.textnorm import lower_ascii
from aerolith.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
BITS_A_LINE = 16
LEAST_FILTER_BITS, MOST_FILTER_BITS = 1 << 20, 1 << 29
SEGMENT_BITS = 1 << 16
WHITE = " \t\n\x0b\x0c\r"
FIRST_BIT = np.array([128, 64, 32, 16, 8, 4, 2, 1], np.uint8)


def line_key(line: str) -> str:
    return lower_ascii(line.strip(WHITE))


def keys_of(text: str | None, min_chars: int) -> set[str]:
    """Distinct keys of a document that are long enough to be dropped."""
    if not text:
        return set()
    return {key for line in text.split("\n") if len(line) >= min_chars and len(key := line_key(line)) >= min_chars}


def bit_places(keys: Iterable[str], bits: int) -> np.ndarray:
    """Two bit places per key, shape (n, 2)."""
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)
    low, high = hashed & np.uint64(0xFFFFFFFF), hashed >> np.uint64(32)
    return np.stack([low % np.uint64(bits), (low + (high | np.uint64(1)) * np.uint64(0x9E3779B1)) % np.uint64(bits)], axis=1).astype(np.int64)


class BitFilter:
    """A Bloom filter of two bits a key, as packed bytes."""

    def __init__(self, bits: int, data: bytes | None = None):
        self.bits = bits
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(bits // 8, np.uint8)

    def add(self, places: np.ndarray) -> None:
        flat = places.ravel()
        np.bitwise_or.at(self.data, flat >> 3, FIRST_BIT[flat & 7])

    def holds(self, places: np.ndarray) -> np.ndarray:
        return (self.data[places >> 3] & FIRST_BIT[places & 7]).astype(bool).all(axis=1)


def _task_filters(batches: Iterator[pa.RecordBatch], bits: int, segment_bits: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    once, twice = BitFilter(bits), BitFilter(bits)
    for batch in batches:
        for text in batch.column(0):
            places = bit_places(keys_of(text.as_py(), min_chars), bits)
            if len(places):
                twice.add(places[once.holds(places)])
                once.add(places)
    step = segment_bits // 8
    for segment in range(bits // segment_bits):
        part = slice(segment * step, (segment + 1) * step)
        if once.data[part].any():
            packed = [zlib.compress(f.data[part].tobytes(), 1) for f in (once, twice)]
            yield pa.RecordBatch.from_pydict({"segment": [segment], "once": [packed[0]], "twice": [packed[1]]})


def _merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for segment, *packed in zip(*(column.to_pylist() for column in batch.columns)):
            once, twice = (np.frombuffer(zlib.decompress(p), np.uint8) for p in packed)
            if segment in merged:
                seen_once, seen_twice = merged[segment]
                merged[segment] = (seen_once | once, seen_twice | twice | (seen_once & once))
            else:
                merged[segment] = (once, twice)
    for segment, (_, twice) in merged.items():
        if twice.any():
            yield pa.RecordBatch.from_pydict({"segment": [segment], "twice": [zlib.compress(twice.tobytes(), 1)]})


def filter_size(docs: DataFrame, min_chars: int = MIN_CHARS) -> int:
    """Bits of a filter for the lines of ``docs``: a power of two, by a sketch
    of how many different lines are long enough to count."""
    lines = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line")).where(F.char_length("line") >= min_chars)
    n = lines.agg(F.approx_count_distinct("line").alias("n")).first()["n"]
    return min(max(1 << (n * BITS_A_LINE).bit_length(), LEAST_FILTER_BITS), MOST_FILTER_BITS)


def repeat_filter(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int = LEAST_FILTER_BITS) -> bytes:
    """Bits of the merged *twice* filter over all of ``docs``: at most
    ``bits / 8`` bytes."""
    if bits % SEGMENT_BITS:
        raise ValueError(f"filter_bits must be a multiple of {SEGMENT_BITS}")
    parts = docs.select(F.col("text").cast("string")).mapInArrow(
        lambda batches: _task_filters(batches, bits, SEGMENT_BITS, min_chars), "segment long, once binary, twice binary"
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = parts.repartition(n, "segment").mapInArrow(_merge_segments, "segment long, twice binary")
    out, step = bytearray(bits // 8), SEGMENT_BITS // 8
    for row in merged.toLocalIterator():
        out[row["segment"] * step : (row["segment"] + 1) * step] = zlib.decompress(row["twice"])
    return bytes(out)


def _batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _nameless() -> Column:
    """What stands for a missing id: a hash of the row's text. Rows of equal
    hashes lose the same keys, each of which any row without id would lose."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("text").cast("string")))


def suspected_keys(docs: DataFrame, twice: bytes, min_chars: int = MIN_CHARS, bits: int = LEAST_FILTER_BITS) -> DataFrame:
    """``doc_id, nameless, key``: each document's distinct keys that may be
    repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(zlib.compress(twice, 1))
    schema = pa.schema([("doc_id", pa.int64()), ("nameless", pa.int64()), ("key", pa.string())])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = BitFilter(bits, zlib.decompress(shared.value))
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, nameless, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                keys = list(keys_of(text.as_py(), min_chars))
                if keys:
                    rows.extend((doc_id, nameless, keys[i]) for i in np.flatnonzero(held.holds(bit_places(keys, bits))))
            yield _batch_of(rows, schema)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _nameless().alias("nameless"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(probe, "doc_id long, nameless long, key string")


def repeated_keys(suspects: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key, keeper``: keys confirmed in at least ``min_docs`` documents."""
    counted = suspects.groupBy("key").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs).select("key", "keeper")


def drop_lines(text: str | None, keys: set[str]) -> tuple[str | None, int, int]:
    """``(kept text, lines before, lines dropped)``."""
    lines = (text or "").split("\n")
    if not keys:
        return text, len(lines), 0
    kept = [line for line in lines if line_key(line) not in keys]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, filter_bits: int | None = None
) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` and the columns
    ``n_lines`` (before) and ``n_dropped`` added (columns of these names are
    replaced). ``filter_bits`` overrides the filter's size."""
    filter_bits = filter_bits or filter_size(docs, min_chars)
    twice = repeat_filter(docs, min_chars, filter_bits)
    suspects = materialize(suspected_keys(docs, twice, min_chars, filter_bits), "suspected-lines")
    # Written, so that it is broadcast by its real size or else shuffled by itself,
    # which lets Spark split the suspects of a hot key.
    repeated = materialize(repeated_keys(suspects, min_docs), "repeated-lines")
    lost = suspects.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    owner = [F.col("doc_id").alias("__lost_doc"), F.col("nameless").alias("__lost_nameless")]
    per_doc = lost.groupBy(*owner).agg(F.collect_set("key").alias("__lost_keys"))
    # Written first, so that the join with the texts is planned by its real size.
    per_doc = materialize(per_doc, "lost-lines")
    docs = docs.drop("n_lines", "n_dropped")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__lost_doc")) & _nameless().eqNullSafe(F.col("__lost_nameless"))
    joined = docs.join(per_doc, same, "left").drop("__lost_doc", "__lost_nameless")

    names = [*docs.columns, "n_lines", "n_dropped"]
    at = [n.lower() for n in names].index("text")
    added = [("n_lines", T.LongType()), ("n_dropped", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, kind) for name, kind in added)])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [drop_lines(t.as_py(), set(k.as_py() or ())) for t, k in zip(batch.column(at), batch.column(len(batch.columns) - 1))]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array([d[0] for d in done], pa.string())
            columns += [pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(rewrite, schema)


def line_dedup_report(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )
