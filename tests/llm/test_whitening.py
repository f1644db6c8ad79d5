"""Whitening against a plain eigenvalue solver on the whole table."""

import math

import numpy as np
import pytest

from odflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int"


def plain(rows):
    """(n, deviations by row, eigenvalues, covariance, whole rows) of the usable rows."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in usable]
    fit = np.array(sorted({x for _, x in whole}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((fit * n - sums) / n).astype(float)
    return n, sums, np.linalg.eigh(centred.T @ centred / n), whole


def check(spark, rows, wanted, **options):
    table = spark.createDataFrame([(i, v, 1, "clash", 2) for i, v in rows], SCHEMA)
    got = whitening.whiten(table.repartition(3), **options).collect()
    n, sums, (values, vectors), whole = plain(rows)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    copies = {}
    for i, x in whole:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, sums))
        copies.setdefault((i, deviation), []).append(x)
    assert set(by_row) == set(copies)
    assert len(got) == wanted * len(whole)
    signs = {}
    for key, xs in copies.items():
        for component in range(1, wanted + 1):
            mine = sorted(r.whitened for r in by_row[key] if r.component == component)
            e, v = values[-component], vectors[:, -component]
            x = np.array([float((n * a - b) / n) for a, b in zip(xs[0], sums)])
            want = float(x @ v / math.sqrt(e))
            if abs(want) > 1e-6:
                signs.setdefault(component, math.copysign(1, want * mine[0]))
            assert np.allclose(mine, [signs.get(component, 1) * want] * len(xs), atol=1e-7)
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[-r.component] / values.sum(), rel_tol=1e-9)


def test_rows_of_every_kind(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(20, 20))
    rows = [(k, (rng.normal(size=20) @ mix).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)] + [(5, rows[5][1]), (None, rows[7][1])]
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [math.nan] * 20), (2004, [math.inf] * 20)]
    check(spark, rows, 16)


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(rng.integers(-5, 5)), float(rng.integers(-3, 3)), 0.5]) for k in range(80)]
    check(spark, rows, 2)


def test_tables_without_components(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(k, [0.5, 0.25], 1, "", 0) for k in range(5)], SCHEMA)
    assert whitening.whiten(same).collect() == []


def test_vectors_of_different_lengths_are_an_error(spark):
    rows = spark.createDataFrame([(1, [0.5, 0.25], 1, "", 0), (2, [0.5], 1, "", 0)], SCHEMA)
    with pytest.raises(ValueError, match="one length"):
        whitening.whiten(rows)


def orthogonal(rng, size):
    return np.linalg.qr(rng.normal(size=(size, size)))[0]


@pytest.mark.parametrize("values", [
    [5.0, 5.0, 5.0, 1.0, 1.0, 0.5, 0.0, 0.0], [3.0] * 8, [1e6, 1e3, 1.0, 1e-3, 1e-4, 0, 0, 0],
    [2.0, 2.0 - 1e-9, 2.0 - 2e-9, 1.0, 1.0 - 1e-12, 0.1, 0.1, 0.1], [1.0], [2.0, 1.0], list(range(64, 0, -1))])
def test_clusters_of_eigenvalues(values):
    rng = np.random.default_rng(len(values))
    q = orthogonal(rng, len(values))
    matrix = (q * values) @ q.T
    wanted = min(16, len(values))
    found, vectors = whitening.leading_eigenvectors((matrix + matrix.T) / 2, wanted)
    scale = max(values)
    assert np.allclose(found, values[:wanted], atol=1e-12 * scale * len(values), rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(wanted), atol=1e-10)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 * scale * len(values)


def test_a_diagonal_matrix_and_zero(spark):
    found, vectors = whitening.leading_eigenvectors(np.diag([1.0, 3.0, 2.0]), 3)
    assert np.allclose(found, [3, 2, 1]) and np.allclose(np.abs(vectors), np.eye(3)[:, [1, 2, 0]])
    assert np.allclose(whitening.leading_eigenvectors(np.zeros((4, 4)), 2)[0], 0)


def test_sturm_counts():
    rng = np.random.default_rng(9)
    diagonal, off = rng.normal(size=30), rng.normal(size=29)
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    for bound in rng.uniform(-4, 4, 50):
        assert whitening.eigenvalues_below(diagonal, off, bound) == (values < bound).sum()
