"""Document fingerprints: a quartile bucket digest with a bounded difference.

Byte triplets of the UTF-8 text, taken at ``TRIPLETS`` offsets so that some
reach over word borders, are hashed into ``BUCKETS`` buckets and counted. Each
bucket is encoded by the quartile its count falls in (two bits), the length by
its logarithm. The digest is hex: two digits of length, then the buckets.

Two digests differ by the sum of their quartile steps (a step over all three
quartiles counts double) plus a capped length step, bounded by
``MAX_DIFFERENCE``; likeness is one minus the bounded share. Equal texts have
equal digests and likeness 1.

``edit_report`` also compares every document with an edited text of itself and
with the next document in descending ``doc_id``. The order is global without a
global sort: ids are cut into ranges by approximate quantiles, each range is
sorted in one task, and the first row of a range is copied to the range before
it (a table of one row per range). Texts are shuffled once and streamed.

Null text counts as empty (all-zero digest). Null ids come last; equal ids are
ordered by a hash of the text. A single document is its own next one. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
# (second, third) byte of a triplet, counted from its first.
TRIPLETS = ((1, 2), (2, 5), (3, 7))
LENGTH_BASE = 1.2
MAX_LENGTH_STEP, LENGTH_WEIGHT = 24, 4
MAX_DIFFERENCE = BUCKETS * 8 // 5
RANGES_PER_PARTITION = 4
QUARTILE_ACCURACY = 100_000


def bucket_counts(data: bytes, buckets: int = BUCKETS) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    counts = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for salt, (second, third) in enumerate(TRIPLETS):
        n = len(raw) - third
        if n <= 0:
            continue
        mixed = raw[:n] * np.uint32(0x9E3779B1)
        mixed += raw[second : second + n] * np.uint32(0x85EBCA6B)
        mixed += raw[third : third + n] * np.uint32(0xC2B2AE35)
        mixed += np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(mixed >> shift, minlength=buckets)
    return counts


def digest(text: str | None) -> str:
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    low, middle, high = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quartile = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    packed = quartile.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = min(math.ceil(math.log(len(data) + 1, LENGTH_BASE)), 255)
    return f"{length:02x}" + packed.astype(np.uint8).tobytes().hex()


def _decoded(fingerprint: str) -> tuple[int, np.ndarray]:
    packed = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    quartile = (packed[1:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return int(packed[0]), quartile.ravel().astype(np.int8)


def difference(a: str, b: str) -> int:
    """0 for equal digests, at most ``MAX_DIFFERENCE``."""
    if a == b:
        return 0
    (length_a, one), (length_b, other) = _decoded(a), _decoded(b)
    step = np.abs(one - other)
    length_step = min(abs(length_a - length_b), MAX_LENGTH_STEP) * LENGTH_WEIGHT
    return min(int(step.sum()) + 3 * int((step == 3).sum()) + length_step, MAX_DIFFERENCE)


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / MAX_DIFFERENCE


def fingerprint_documents(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the digest of ``text_col`` in ``out_col``."""

    @F.pandas_udf("string")
    def digests(texts: pd.Series) -> pd.Series:
        return texts.map(digest, na_action=None)

    return docs.withColumn(out_col, digests(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def edited_text(text: str, following: str) -> str:
    """The last ``floor(n/2)`` code points replaced by the first as many (or
    all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _in_ranges(docs: DataFrame) -> DataFrame:
    """``range, guest, key, tie, doc_id, text``: every row in the id range it
    belongs to, and the first row of a range again, as guest, in the range
    before (of the first range: in the last)."""
    spark = docs.sparkSession
    lowest = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(lowest).cast("long")))
    rows = rows.withColumn("tie", F.bitwise_not(F.xxhash64("text")))
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    cuts = rows.agg(F.percentile_approx("key", shares, QUARTILE_ACCURACY).alias("cuts")).first()["cuts"] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        # Descending: range 0 holds the largest ids.
        return pd.Series(len(bounds) - np.searchsorted(bounds, keys.to_numpy(np.int64), side="right"), dtype="int32")

    heads = rows.select("key", "tie").withColumn("range", range_of("key")).groupBy("range")
    first = sorted((r["range"], r["head"]["key"], r["head"]["tie"]) for r in heads.agg(F.max(F.struct("key", "tie")).alias("head")).collect())
    guests = [(key, tie, first[i - 1][0]) for i, (_, key, tie) in enumerate(first)]
    guests_table = spark.createDataFrame(guests or [(0, 0, -1)], "head_key long, head_tie long, before int")
    placed = rows.withColumn("range", range_of("key")).join(
        F.broadcast(guests_table), (F.col("key") == F.col("head_key")) & (F.col("tie") == F.col("head_tie")), "left"
    )
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guest))
    return placed.select("key", "tie", "doc_id", "text", F.inline(places).alias("range", "guest"))


def with_next(docs: DataFrame) -> DataFrame:
    """``range, guest, doc_id, text`` so laid out that in a task each range is
    a run of rows in descending id, its guest (the next range's first) last."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = _in_ranges(docs).repartition(n, "range")
    return laid.sortWithinPartitions("range", "guest", F.desc("key"), F.desc("tie")).select("range", "guest", "doc_id", "text")


REPORT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their
    likeness to each other and to the next document."""
    names = [c.split()[0] for c in REPORT_SCHEMA.split(", ")]

    def compare(row: tuple, following: tuple) -> tuple:
        (_, doc_id, text, own), (_, _, next_text, next_own) = row, following
        edited = edited_text(text, next_text)
        changed = digest(edited)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), sha, own, changed, likeness(own, changed), likeness(own, next_own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        schema = pa.schema([(n, t) for n, t in zip(names, [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])])
        for batch in batches:
            out = []
            for part, guest, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                whole = text.as_py() or ""
                row = (part, doc_id, whole, digest(whole))
                if held and held[0] == part:
                    out.append(compare(held, row))
                # After a guest nothing of its range is left to compare.
                held = None if guest else row
            columns = list(zip(*out)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return with_next(docs).mapInArrow(run, REPORT_SCHEMA)
