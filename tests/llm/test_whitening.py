"""Whitening against plain float64 formulas; refined eigenvectors against known ones."""

from __future__ import annotations

import numpy as np
import pytest

from aerolith.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def known_matrix(values, seed=0):
    """A symmetric matrix in extended precision with the given eigenvalues."""
    size = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (1.5 * np.eye(size) - 0.5 * (q.T @ q))
    return (q * np.asarray(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(10, 1, 24),
        [5, 5 - 1e-6, 5 - 2e-6, 3, 3 - 1e-9, 2, 1, 0.5],
        [4 + 1e-11, 4, 4 - 1e-11, 1, 1 - 1e-12],
        [1e6, 1e6 * (1 - 1e-8), 1.0, 1e-3, 1e-3 * (1 - 1e-4)],
        [7.0],
    ],
)
def test_refined_eigenvectors(values):
    matrix, q = known_matrix(values)
    got_values, got = whitening.refined_eigenvectors(matrix)
    values = np.asarray(values, np.longdouble)
    norm = values.max()
    assert np.abs(got_values - values).max() <= 1e-16 * norm
    assert np.abs(got.T @ got - np.eye(len(values))).max() < 1e-16
    gap = min(abs(a - b) for i, a in enumerate(values) for b in values[:i]) if len(values) > 1 else norm
    tolerance = max(1e-15, 1e-17 * norm / gap)  # what extended precision can tell apart
    assert np.abs(np.abs(np.sum(q * got, axis=0)) - 1).max() <= max(1e-15, tolerance**2)
    assert np.abs(np.abs(q) - np.abs(got)).max() <= tolerance


def test_equal_eigenvalues_give_an_orthonormal_basis():
    for values in ([2, 2, 2, 1, 1, 0, 0, 0], [3] * 5, [0] * 4):
        matrix, _ = known_matrix(values)
        got_values, got = whitening.refined_eigenvectors(matrix)
        assert np.abs(got_values - np.array(values)).max() < 1e-17 * 10
        assert np.abs(got.T @ got - np.eye(len(values))).max() < 1e-16
        assert np.abs(matrix @ got - got * got_values).max() < 1e-16


def plain(vectors):
    x = np.floor(64 * np.asarray(vectors, np.float64)) + 1_000_000
    n = len(x)
    centred = x - x.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    ints = x.astype(np.int64).astype(object)
    deviation = ((ints * n - ints.sum(axis=0)) ** 2).sum(axis=1)
    return centred @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n), deviation


def test_supplied_vectors(spark, table):
    rows = table("embeddings").select("vec_id", "embedding")
    odd = [(-1, None), (-2, [None] * 64), (-3, [float("nan")] * 64), (-4, [float("inf")] * 64)]
    got = whitening.whitening_report(rows.unionByName(spark.createDataFrame(odd, "vec_id long, embedding array<float>")).repartition(7)).toPandas()
    source = rows.toPandas().sort_values("vec_id")
    whitened, explained, deviation = plain(np.stack(source.embedding))
    assert len(got) == len(source) * 32 and set(got.n) == {len(source)}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").sort_index()
    assert list(wide.index) == list(source.vec_id) and list(wide.columns) == list(range(1, 33))
    assert np.abs(np.abs(wide.values) - np.abs(whitened)).max() < 1e-9
    signs = np.sign(wide.values * whitened).sum(axis=0)
    assert (np.abs(signs) == len(source)).all()
    shares = got.groupby("component").explained.first().values
    assert np.abs(shares / explained - 1).max() < 1e-9
    assert list(got.groupby("vec_id").deviation.first().sort_index()) == list(deviation)
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-10


def test_nulls_repeats_and_components_without_variance(spark):
    rows = [(None, [1.0, 2.0, 3.0], 1), (1, [0.0, 0.5, -1.0], 1), (1, [0.0, 0.5, -1.0], 1), (2, [9.0, 0.5, -1.5], None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("deviation", whitening.F.lit("mine"))
    got = whitening.whitening_report(frame).collect()
    assert len(got) == 12 and all((r.whitened is None) == (r.component == 3) for r in got)
    assert all(abs(r.identity_error) < 1e-10 and r.n == 4 for r in got)
    same = whitening.whitening_report(spark.createDataFrame([(i, [0.5, 0.25], 1) for i in range(3)], SCHEMA)).collect()
    assert len(same) == 6 and all(r.whitened is None and r.identity_error is None and r.deviation == 0 for r in same)


def test_empty_tables_and_wrong_shapes(spark):
    assert whitening.whitening_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitening_report(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="components"):
        whitening.whitening_report(spark.createDataFrame([(1, [0.0], 1), (2, [0.0, 1.0], 1)], SCHEMA)).collect()


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-(2**33), 2**33, (60, 4)).astype(np.float64)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    made = whitening.fit(rows)
    assert made.identity_error < 1e-9
    _, _, deviation = plain(vectors)
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(rows, made).collect()}
    assert got == dict(enumerate(deviation))
    assert {r.deviation for r in whitening.whitening_report(rows).collect()} == {None}
