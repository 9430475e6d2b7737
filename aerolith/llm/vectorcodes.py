"""Vector compression: each part of a vector becomes the index of its nearest
codebook entry.

Vectors are taken as integers, ``floor(scale * x)``, and cut into ``parts``
equal consecutive parts. All arithmetic is on integers, so neither the order of
rows nor their partitioning can change a code, an error or an entry.

*Distances.* Rows are handled in blocks. A block's values of one dimension
become a dictionary of its distinct integers and a code per row; the squared
differences of every distinct integer to all entries are tabulated once, and a
part's distances are gathers of those table rows by code, added up over the
part's dimensions. Dictionaries are as large as a block at most, so nothing that
grows with the corpus is broadcast; the codebooks are (``entries`` vectors).

*Fit.* Entries start as the parts of the ``entries`` vectors of smallest id. In
each round every task sums the parts of each entry over its rows; those sums
(``entries`` vectors a task) are added up in Spark, and each used entry becomes
its parts' componentwise ``floor(sum / count)``.

Dropped: rows whose vector is null or holds null, NaN or infinite components.
Ties go to the lower index. Repeated rows count each. Null ids come after all
others; equal ids are ordered by vector. With fewer rows than entries the
codebooks are as many rows long; an empty table gives an empty result. Vectors
of different lengths, a length that the parts don't divide, and components too
large for exact 64-bit distances (2**19 at 96 dimensions) raise ValueError.
Columns beside id and vector are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.arrow import add_columns, as_matrix, finite_vectors
from aerolith.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 2048


@dataclass
class Codebooks:
    """``entries``: whole vectors of integers; entry ``e`` of part ``p`` is row
    ``e`` at the part's dimensions."""

    entries: np.ndarray
    parts: int
    scale: int

    @property
    def width(self) -> int:
        return self.entries.shape[1] // self.parts

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position in the part."""
        by_part = self.entries.reshape(len(self.entries), self.parts, -1).transpose(1, 0, 2)
        return hashlib.sha256(",".join(map(str, by_part.ravel().tolist())).encode()).hexdigest()

    def integers(self, column: pa.Array) -> np.ndarray:
        values = np.floor(as_matrix(column, self.entries.shape[1]) * self.scale)
        if len(values) and 4 * np.abs(values).max() ** 2 * values.shape[1] >= 2.0**62:
            raise ValueError("a component is too large for exact distances")
        return values.astype(np.int64)

    def assign(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance to it, per row and part."""
        rows, width = len(values), self.width
        codes = np.empty((rows, self.parts), np.int64)
        errors = np.empty((rows, self.parts), np.int64)
        for part in range(self.parts):
            distance = np.zeros((rows, len(self.entries)), np.int64)
            for dim in range(part * width, (part + 1) * width):
                distinct, code = np.unique(values[:, dim], return_inverse=True)
                table = (distinct[:, None] - self.entries[None, :, dim]) ** 2
                distance += table[code]
            codes[:, part] = distance.argmin(axis=1)
            errors[:, part] = distance[np.arange(rows), codes[:, part]]
        return codes, errors


def _first_entries(vectors: DataFrame, vector: str, id_col: str, parts: int, entries: int, scale: int) -> Codebooks | None:
    first = vectors.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = [r.v for r in first.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()]
    if not rows:
        return None
    if len({len(v) for v in rows}) > 1 or len(rows[0]) % parts:
        raise ValueError(f"vectors of {sorted({len(v) for v in rows})} components do not make {parts} equal parts")
    empty = Codebooks(np.zeros((1, len(rows[0])), np.int64), parts, scale)
    return Codebooks(empty.integers(pa.array(rows, pa.list_(pa.float64()))), parts, scale)


def _entry_sums(vectors: DataFrame, vector: str, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the assigned parts and their counts, per entry and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, width = books.entries.shape, books.width
        sums, counts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                values = books.integers(whole.column(0).slice(start, BLOCK))
                codes, _ = books.assign(values)
                for part in range(books.parts):
                    dims = slice(part * width, (part + 1) * width)
                    order = np.argsort(codes[:, part], kind="stable")
                    used, first, n = np.unique(codes[order, part], return_index=True, return_counts=True)
                    if len(used):
                        sums[used, dims] += np.add.reduceat(values[order, dims], first, axis=0)
                        counts[used, dims] += n[:, None]
        entry, dim = np.nonzero(counts)
        columns = [entry.astype(np.int32), dim.astype(np.int32), sums[entry, dim], counts[entry, dim]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["entry", "dim", "total", "n"])

    partial = vectors.select(F.col(vector)).mapInArrow(run, "entry int, dim int, total long, n long")
    sums, counts = np.zeros(books.entries.shape, np.int64), np.zeros(books.entries.shape, np.int64)
    for r in partial.groupBy("entry", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        sums[r.entry, r.dim], counts[r.entry, r.dim] = r.total, r.n
    return sums, counts


def fit(
    vectors: DataFrame,
    vector: str = "embedding",
    id_col: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks of all vectors; None if there are none."""
    vectors = finite_vectors(vectors, vector)
    books = _first_entries(vectors, vector, id_col, parts, entries, scale)
    for _ in range(rounds if books else 0):
        sums, counts = _entry_sums(vectors, vector, books)
        books = Codebooks(np.where(counts > 0, sums // np.maximum(counts, 1), books.entries), parts, scale)
    return books


def compress(vectors: DataFrame, books: Codebooks | None, vector: str = "embedding") -> DataFrame:
    """The kept rows without their vector, with ``code`` (one byte a part) and
    ``error``, the squared distances summed over the parts."""
    kept = finite_vectors(vectors, vector)
    fields = [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]

    def make(column: pa.Array) -> list[pa.Array]:
        codes, errors = books.assign(books.integers(column))
        return [pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary()), pa.array(errors.sum(axis=1))]

    return add_columns(kept if books else kept.limit(0), F.col(vector), fields, make, BLOCK, without=vector)


def decompress(codes: DataFrame, books: Codebooks, out_col: str = "vector") -> DataFrame:
    """``codes`` with the vector that each code stands for."""
    whole = [[x / books.scale for x in row] for row in books.entries.tolist()]
    book = F.array(*[F.array(*map(F.lit, row)) for row in whole])
    at = F.array(*[F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int") for p in range(books.parts)])
    return codes.withColumn(out_col, F.flatten(F.transform(at, lambda e, p: F.slice(F.get(book, e), p * books.width + 1, books.width))))


def vector_code_report(embeddings: DataFrame) -> DataFrame:
    """Codes and errors per vector; the errors of each label are summed over a
    written table, so that a label of many rows is one row when it is joined back."""
    rows = embeddings.select("vec_id", "label", "embedding")
    books = fit(rows)
    coded = materialize(compress(rows, books), "vector-codes")
    per_label = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-code-labels")
    joined = coded.alias("c").join(per_label.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
    return joined.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest() if books else "").alias("codebooks_sha256"),
    )
