"""Whitening against a plain eigendecomposition, the factorisation alone, and odd rows."""

import math

import numpy as np
import pytest

from acctlake.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def run(spark, rows, schema=SCHEMA, components=4):
    whole = W.whole_vectors(spark.createDataFrame(rows, schema))
    return whole, W.whiten(whole, W.fit_whitening(whole, components)).collect()


def plain(rows):
    """Per row id: deviation and whitened coordinates up to sign; explained shares."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centre = (fit * n - sums).astype(float) / n
    values, vectors = np.linalg.eigh(centre.T @ centre / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in kept:
        numerators = np.array(x, dtype=object) * n - sums
        out[i] = (int((numerators * numerators).sum()), numerators.astype(float) / n @ vectors / np.sqrt(np.abs(values)))
    return n, out, values / values.sum()


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(9, 9)) * np.array([5, 3, 2, 1, 1, 0.5, 0.2, 0.1, 0.05])
    rows = [(i, (rng.normal(size=9) @ mix).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(500)]
    n, expected, explained = plain(rows)
    _, found = run(spark, rows)
    assert len(found) == 4 * len(rows) and {r.n for r in found} == {n}
    signs = {}
    for r in found:
        deviation, coordinates = expected[r.vec_id]
        assert r.deviation == deviation
        want = coordinates[r.component - 1]
        sign = signs.setdefault(r.component, 1 if (r.whitened > 0) == (want > 0) else -1)
        assert r.whitened == pytest.approx(sign * want, rel=1e-8, abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


@pytest.mark.parametrize("size,rank", [(1, 1), (2, 2), (7, 3), (12, 12), (33, 20)])
def test_factor_and_rotations(size, rank):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(size, rank)) * 10.0 ** rng.uniform(-4, 4, rank)
    scatter = a @ a.T
    factor = W.pivoted_cholesky(scatter)
    assert factor.shape[1] <= rank and np.allclose(factor @ factor.T, scatter, rtol=1e-9, atol=1e-9 * scatter.max())
    directions, values = W.principal(scatter, size)
    assert np.allclose(directions.T @ directions, np.eye(len(values)), atol=1e-10)
    assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1][: len(values)], rtol=1e-7, atol=1e-10 * scatter.max())
    assert np.all(np.diff(values) <= 0)


def test_rows_that_take_no_part(spark):
    good = [(i, [float(i), float(i * i % 7)]) for i in range(10)]
    rows = [*good, (20, None), (21, [1.0, None]), (22, [1.0, float("nan")]), (23, [float("inf"), 0.0]), (24, []), (None, [1.0, 1.0])]
    _, found = run(spark, rows)
    ids = [r.vec_id for r in found]
    assert sorted({i for i in ids if i is not None}) == list(range(10)) and ids.count(None) == 2
    # The row without an id has the whole numbers of row 1, so the fit has ten vectors.
    assert {r.n for r in found} == {10}


def test_lengths_apart_and_rank(spark):
    rows = [(i, [float(i), 0.0, 1.0]) for i in range(5)] + [(10 + i, [float(i % 2), float(i // 2)]) for i in range(4)] + [(30, [5.0])]
    _, found = run(spark, rows)
    by_id = {i: [r for r in found if r.vec_id == i] for i in {r.vec_id for r in found}}
    assert len(by_id[0]) == 1 and by_id[0][0].explained == pytest.approx(1.0)
    assert len(by_id[10]) == 2 and by_id[10][0].n == 4
    assert 30 not in by_id
    assert by_id[4][0].whitened ** 2 == pytest.approx(2.0)


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2**40 + i), float(-(2**41) * (i % 3))]) for i in range(6)] + [(9, [1e300, 0.0])]
    _, found = run(spark, rows, "vec_id long, embedding array<double>")
    x = np.array([[256 * (2**40 + i), -256 * 2**41 * (i % 3)] for i in range(6)], dtype=object)
    sums = x.sum(axis=0)
    for r in found:
        exact = int(((x[r.vec_id] * 6 - sums) ** 2).sum())
        assert r.deviation == (exact if exact < 2**63 else None)
    assert {r.vec_id for r in found} == set(range(6))


def test_empty_table_and_other_columns(spark):
    assert run(spark, [])[1] == []
    rows = [(1, [1.0, 2.0], 5, "x"), (2, [2.0, 1.0], 6, "y"), (2, [2.0, 1.0], 6, "y")]
    _, found = run(spark, rows, "vec_id long, embedding array<float>, n long, x string")
    assert sorted(r.vec_id for r in found) == [1, 2, 2] and {r.n for r in found} == {2}
