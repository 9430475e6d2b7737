"""Bounded, repeatable samples of labelled documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.session import materialize

# Sparse non-negative counts: (places, counts).
Sparse = tuple[np.ndarray, np.ndarray]


def id_remainder(doc_id: Column, n: int) -> Column:
    """``crc32`` of the id's text modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


# Hash bits that a level of the search for a label's cut-off looks at.
LEVEL_BITS, LEVELS = 10, 2


def _up_to_cutoff(rows: DataFrame, most: int, level: int) -> DataFrame:
    """``rows`` (``doc_id, label, hash``) up to the hash range in which a label
    reaches ``most`` ids. Only counts of ranges are shuffled, ``2**LEVEL_BITS``
    a label and task at most."""
    ranged = rows.withColumn("range", F.shiftright("hash", 64 - LEVEL_BITS * level))
    counts = ranged.groupBy("label", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("label").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < most)
    # Written, so that few labels are broadcast by their file size: the rows of a
    # label then stay where they are.
    last = materialize(needed.groupBy("label").agg(F.max("range").alias("last")), "label-ranges")
    return ranged.join(last, "label").where(F.col("range") <= F.col("last")).select("doc_id", "label", "hash")


def sample_per_label(labelled: DataFrame, label: str, per_label: int) -> DataFrame:
    """The ``per_label`` distinct ids of each label with the lowest hashes:
    ``doc_id, label``. An id that has several labels counts for the largest.

    How far the hashes of a label must reach is found by counting hash ranges,
    then ranges inside the last one; what meets in one task to be ranked is
    ``per_label`` ids of a label and about one in ``2**(LEVEL_BITS * LEVELS)`` of
    the others."""
    rows = labelled.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    rows = rows.withColumn("hash", F.xxhash64("doc_id"))
    for level in range(1, LEVELS + 1):
        rows = materialize(_up_to_cutoff(rows, per_label, level), "sampled-ids")
    order = Window.partitionBy("label").orderBy("hash", "doc_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label).select("doc_id", "label")


def sampled_features(
    docs: DataFrame, sample: DataFrame, features: Callable[[str], Sparse], label: str | None = None
) -> list[tuple[object, Sparse]]:
    """``(label, features of the whole text)`` of the sampled ids, one each, in
    the order of their ids: of several rows of an id, the text with the lowest
    hash (with ``label``, a column of ``docs``: of those with the sampled label).
    The sample is broadcast: its size is bounded by its own parameter.
    Rows of a repeated id collapse in each task. Features, not texts, reach the
    driver, one row per sampled id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(2)]
            places = pa.array([p.astype("<u2").tobytes() for p, _ in found], pa.binary())
            counts = pa.array([c.astype("<f4").tobytes() for _, c in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), places, counts], names=["doc_id", "label", "places", "counts"])

    own = F.lit(None).cast("string") if label is None else F.col(label).cast("string")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, own.alias("own"))
    chosen = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("string").alias("label"))
    joined = rows.join(F.broadcast(chosen), "doc_id")
    if label is not None:
        joined = joined.where(F.col("own") == F.col("label"))
    one = joined.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    sent = one.select("doc_id", "label", "first.text").mapInArrow(run, "doc_id long, label string, places binary, counts binary")
    found = sorted(sent.toLocalIterator(), key=lambda r: r["doc_id"])
    return [(r["label"], (np.frombuffer(r["places"], "<u2"), np.frombuffer(r["counts"], "<f4"))) for r in found]


def dense(rows: list[Sparse], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for row, (places, counts) in zip(out, rows):
        row[places] = counts
    return out
