"""Whitening of embeddings: centred vectors projected on the leading
eigenvectors of their covariance, each divided by its standard deviation.

Components become integers ``x = floor(scale * c) + offset``, so counts, sums
and products are exact at any size:

* one pass counts rows and sums every dimension;
* a second pass adds up the products of ``a = x - m``, where ``m`` is the mean
  rounded to an integer. Blocks are multiplied in doubles that hold every sum
  exactly (larger values are cut into limbs of 20 bits first) and added as
  integers. With ``d = sum(x) - n * m`` the covariance is exactly
  ``(n * sum(a a') - d d') / n**2``: centred before multiplying, rounded once.

*Eigenvectors.* The first ones come from a float32 solver. Iterations after
Ogita and Aishima correct them with matrix products in extended precision
(``longdouble``): from ``R = I - X'X`` and ``S = X'VX`` follow better
eigenvalues and a correction of every pair of vectors, with quadratic
convergence. Pairs whose eigenvalues are too near to tell apart at the current
error form clusters: their basis is made orthonormal, and the covariance
projected on it, less its mean eigenvalue, is solved by itself and the basis
turned accordingly. Signs are chosen so that the largest entry is positive.

The matrices on the driver are of the vectors' dimension, whatever the corpus.
A third pass checks the result: the covariance of the whitened vectors minus
the identity.

Dropped: vectors that are null or hold null, NaN or infinite entries. Repeated
rows count each; null ids, ties and further columns are carried along; an empty
table gives an empty result. A component without variance (up to rounding), such
as any beyond the number of different rows, whitens to null and is left out of
the check. Vectors of different lengths and entries of 2**40 or more raise
ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.arrow import add_columns, as_matrix, finite_vectors

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
BLOCK = 4096
LIMB_BITS = 20
LARGEST = 2.0**46  # scaled entries
EXACT = "decimal(38,0)"
EXACT_ARROW = pa.decimal128(38, 0)
MOST_ROUNDS = 30
NEAR = 1e-6  # distance of eigenvalues, against the largest entry, that are solved together


@dataclass
class Whitening:
    """``n`` rows with sums ``sums`` of every dimension; ``vectors`` holds the
    unit eigenvectors as columns and ``values`` their eigenvalues, falling;
    ``live`` marks those with variance. ``reach`` bounds ``x - mean``."""

    n: int
    sums: list[int]
    mean: list[int]
    reach: int
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    live: np.ndarray
    identity_error: float | None = None

    @property
    def rest(self) -> list[int]:
        """``sum(x) - n * m`` of every dimension."""
        return [s - self.n * m for s, m in zip(self.sums, self.mean)]


def _integers(column: pa.Array, width: int) -> np.ndarray:
    values = np.floor(as_matrix(column, width) * SCALE)
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError("an entry is too large")
    return values.astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK):
            yield _integers(whole.column(0).slice(start, BLOCK), width)


def _exact(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], EXACT_ARROW)


def _column_sums(vectors: DataFrame, width: int) -> tuple[int, list[int], int, int]:
    """Rows, sums, least and largest value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, [0] * width, np.full(width, 2**62), np.full(width, -(2**62))
        for x in _blocks(batches, width):
            n += len(x)
            sums = [a + b for a, b in zip(sums, x.sum(axis=0).tolist())]
            low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if n:
            columns = [pa.array(np.arange(width, dtype=np.int32)), _exact(sums), pa.array(low), pa.array(high), pa.array([n] * width, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "total", "low", "high", "n"])

    partial = vectors.mapInArrow(run, f"dim int, total {EXACT}, low long, high long, n long")
    rows = partial.groupBy("dim").agg(F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).orderBy("dim").collect()
    return rows[0].n, [int(r.total) for r in rows], min(r.low for r in rows), max(r.high for r in rows)


def _limbs(a: np.ndarray, reach: int) -> list[np.ndarray]:
    """``a`` as parts of ``LIMB_BITS`` bits, lowest first, as doubles."""
    out = []
    while reach >> LIMB_BITS:
        out.append((a & ((1 << LIMB_BITS) - 1)).astype(np.float64))
        a, reach = a >> LIMB_BITS, (reach >> LIMB_BITS) + 1
    return [*out, a.astype(np.float64)]


def _products(vectors: DataFrame, width: int, mean: list[int], reach: int) -> list[list[int]]:
    """``sum(a a')`` over all rows, exactly."""
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(len(i), object), False
        part = np.zeros(len(i), np.int64)
        middle = np.array(mean, np.int64)
        small = reach < 1 << LIMB_BITS
        for x in _blocks(batches, width):
            any_rows = True
            limbs = _limbs(x - middle, reach)
            for k, a in enumerate(limbs):
                for m, b in enumerate(limbs):
                    block = (a.T @ b)[i, j].astype(np.int64)
                    if small:
                        part += block
                    else:
                        total += block.astype(object) << (LIMB_BITS * (k + m))
            if small and np.abs(part).max() >> 61:
                total, part = total + part.astype(object), np.zeros(len(i), np.int64)
        if any_rows:
            sums = (total + part.astype(object)).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _exact(sums)], names=["i", "j", "total"])

    partial = vectors.mapInArrow(run, f"i int, j int, total {EXACT}")
    out = [[0] * width for _ in range(width)]
    for r in partial.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r.i][r.j] = out[r.j][r.i] = int(r.total)
    return out


def _long(whole: int) -> np.longdouble:
    """An integer of any size, rounded to extended precision."""
    head = float(whole)
    return np.longdouble(head) + np.longdouble(float(whole - int(head)))


def refined_eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix: a float32 solution refined in the precision of ``longdouble``."""
    v = np.asarray(matrix, np.longdouble)
    size = len(v)
    norm = np.abs(v).max(initial=0)
    if not norm:
        return np.zeros(size, np.longdouble), np.eye(size, dtype=np.longdouble)
    v = v / norm
    x = np.linalg.eigh(v.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    eps, identity, before = np.finfo(np.longdouble).eps, np.eye(size, dtype=np.longdouble), np.inf
    for _ in range(MOST_ROUNDS):
        r = identity - x.T @ x
        s = x.T @ (v @ x)
        values = np.diag(s) / (1 - np.diag(r))
        residual = s - np.diag(values)
        spread = 2 * (np.sqrt((residual**2).sum()) + np.sqrt((v**2).sum()) * np.sqrt((r**2).sum()))
        near = max(spread, NEAR)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        correction = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = _solve_clusters(v, x + x @ correction, values, near)
        size_of = np.abs(correction).max()
        if size_of <= 4 * size * eps or (size_of < 1e-10 and size_of > before / 2):
            break
        before = size_of
    for _ in range(2):
        x = _orthonormal(x)
    values = (x * (v @ x)).sum(axis=0) / (x * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    largest = np.abs(x).argmax(axis=0)
    return values[order] * norm, x * np.where(x[largest, np.arange(size)] < 0, -1, 1)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """A Newton step towards an orthonormal basis of the same space."""
    return x @ (1.5 * np.eye(x.shape[1], dtype=np.longdouble) - 0.5 * (x.T @ x))


def _solve_clusters(v: np.ndarray, x: np.ndarray, values: np.ndarray, near: np.longdouble) -> np.ndarray:
    """``x`` with the basis of each cluster of eigenvalues, chained by distances
    up to ``near``, turned to the eigenvectors of the matrix projected on it."""
    order = np.argsort(-values, kind="stable")
    borders = np.flatnonzero(values[order][:-1] - values[order][1:] > near) + 1
    for cluster in np.split(order, borders):
        if len(cluster) > 1:
            basis = x[:, cluster]
            for _ in range(3):
                basis = _orthonormal(basis)
            inside = basis.T @ (v @ basis - values[cluster].mean() * basis)
            x[:, cluster] = basis @ np.linalg.eigh(((inside + inside.T) / 2).astype(np.float64))[1][:, ::-1].astype(np.longdouble)
    return x


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all sound vectors; None if there are none."""
    only = finite_vectors(vectors, vector).select(F.col(vector).alias("v"))
    first = only.select(F.size("v").alias("width")).head()
    if first is None:
        return None
    width = first.width
    n, sums, low, high = _column_sums(only, width)
    mean = [(2 * s + n) // (2 * n) for s in sums]
    reach = max(high - min(mean), max(mean) - low, 1)
    products = _products(only, width, mean, reach)
    rest = [s - n * m for s, m in zip(sums, mean)]
    square = _long(n * n)
    covariance = np.array([[_long(n * products[i][j] - rest[i] * rest[j]) / square for j in range(width)] for i in range(width)], np.longdouble)
    values, found = refined_eigenvectors(covariance)
    trace = covariance.diagonal().sum()
    kept = min(components, width)
    values = values[:kept]
    live = values > trace * width * np.finfo(np.float64).eps
    made = Whitening(n, sums, mean, reach, found[:, :kept].astype(np.float64), values.astype(np.float64), float(trace), live)
    made.identity_error = _identity_error(only, width, made)
    return made


def _projection(made: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Mean of ``a`` and the matrix that whitens ``a`` less it."""
    middle = np.array([float(_long(d) / _long(made.n)) for d in made.rest])
    return middle, made.vectors[:, made.live] / np.sqrt(made.values[made.live])


def _identity_error(vectors: DataFrame, width: int, made: Whitening) -> float | None:
    middle, matrix = _projection(made)
    live = matrix.shape[1]
    if not live:
        return None
    i, j = np.triu_indices(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product, total = np.zeros((live, live)), np.zeros(live)
        shift = np.array(made.mean, np.int64)
        for x in _blocks(batches, width):
            w = ((x - shift).astype(np.float64) - middle) @ matrix
            product += w.T @ w
            total += w.sum(axis=0)
        rows = [np.r_[i, np.arange(live)].astype(np.int32), np.r_[j, np.full(live, -1)].astype(np.int32), np.r_[product[i, j], total]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["i", "j", "total"])

    summed = {(r.i, r.j): r.total for r in vectors.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    mean = [summed[k, -1] / made.n for k in range(live)]
    return max(abs(summed[a, b] / made.n - mean[a] * mean[b] - (a == b)) for a, b in zip(i.tolist(), j.tolist()))


def _deviations(a: np.ndarray, made: Whitening) -> list[int]:
    """``sum((n * x - S) ** 2)`` of each row, exactly."""
    largest = made.n * made.reach + max(map(abs, made.rest))
    kind = np.int64 if a.shape[1] * largest * largest < 1 << 63 else object
    scaled = a.astype(kind) * made.n - np.array(made.rest, kind)
    return (scaled * scaled).sum(axis=1).tolist()


def whiten(vectors: DataFrame, made: Whitening | None, vector: str = "embedding") -> DataFrame:
    """The sound rows without their vector, with ``whitened`` (null entries for
    components without variance) and ``deviation``, the exact sum of
    ``(n * x - S) ** 2`` over the dimensions."""
    kept = finite_vectors(vectors, vector)
    fields = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.DecimalType(38, 0))]

    def make(column: pa.Array) -> list[pa.Array]:
        middle, matrix = _projection(made)
        a = _integers(column, len(made.sums)) - np.array(made.mean, np.int64)
        out = np.full((len(a), len(made.live)), np.nan)
        out[:, made.live] = (a.astype(np.float64) - middle) @ matrix
        offsets = pa.array(np.arange(len(a) + 1, dtype=np.int32) * out.shape[1], pa.int32())
        return [pa.ListArray.from_arrays(offsets, pa.array(out.ravel(), from_pandas=True)), _exact(_deviations(a, made))]

    return add_columns(kept if made else kept.limit(0), F.col(vector), fields, make, BLOCK, without=vector)


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """One row per sound vector and component. A deviation beyond 64 bits, which
    the column's type can't hold, is null; ``whiten`` has it as a decimal."""
    rows = embeddings.select("vec_id", "embedding")
    made = fit(rows)
    shares = [float(v / made.trace) if made.trace else None for v in made.values] if made else []
    by_component = F.array(*[F.lit(s).cast("double") for s in shares]).cast("array<double>")
    return whiten(rows, made).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(made.n if made else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(by_component, F.col("place")).alias("explained"),
        F.lit(made.identity_error if made else None).cast("double").alias("identity_error"),
    )
