"""Nearest vectors: the curve itself, recall against brute force, and odd rows."""

import itertools
import math
from fractions import Fraction

import numpy as np
import pytest

from acctlake.llm import nearest as A
from acctlake.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"
ASKED = "vec_id % 50 = 0"


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (4, 2), (6, 2)])
def test_curve_visits_all_cells_in_steps_of_one(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = A.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def brute(rows, k=5):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(np.float32(v))), None)
    out = {}
    for size in {len(v) for _, v in ok}:
        ids = [i for i, v in ok if len(v) == size]
        x = np.array([v for _, v in ok if len(v) == size], dtype=np.float64)
        for n, i in enumerate(ids):
            if i % 50 == 0:
                near = sorted((-s, j) for s, j in zip(A.cosine(x[n], x), ids) if j != i)
                if near:
                    out[i] = [(j, -s) for s, j in near[:k]]
    return out


def lists(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_given_vectors(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    found = A.nearest(vectors, ASKED)
    exact = brute([(r.vec_id, r.embedding) for r in vectors.collect()])
    rows = [(q, j) for q, near in exact.items() for j, _ in near]
    frame = spark.createDataFrame(rows, "query_id long, vec_id long")
    assert A.recall(found, frame) >= 0.9
    got = lists(found)
    assert set(got) == set(exact)
    for q, near in got.items():
        assert len(near) == 5 and near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert near[0][1] <= exact[q][0][1] + 1e-12


def test_full_window_is_exact_with_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 32)
    monkeypatch.setattr(A, "CHUNK_QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(2000 + i, [2 * x for x in rows[50][1]]) for i in range(7)]
    rows += [(5000, None), (5050, [0.0] * 8), (5100, [1.0] * 7 + [float("nan")]), (5150, [1.0] * 7 + [None]), (5200, [1.0, 2.0]),
             (5400, [2.0, 1.0]), (5450, [-1.0, 3.0]), (5500, [1.0] * 9), (5250, [float("inf")] * 8), (None, rows[3][1]), (100, rows[100][1]), (5300, [])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = lists(A.nearest(frame, ASKED, share=2.0, curves=2))
    exact = brute(rows)
    assert {q: [j for j, _ in near] for q, near in got.items()} == {q: [j for j, _ in near] for q, near in exact.items()}
    for q in got:
        assert np.allclose([s for _, s in got[q]], [s for _, s in exact[q]], rtol=0, atol=1e-15)


def test_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])]
    got = lists(A.nearest(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), ASKED))
    assert {q: [j for j, _ in near] for q, near in got.items()} == {0: [1, 50], 50: [1, 0]}
    assert lists(A.nearest(spark.createDataFrame([(0, [1.0], 0)], SCHEMA), ASKED)) == {}
    assert lists(A.nearest(spark.createDataFrame([], SCHEMA), ASKED)) == {}


def test_every_dimension_and_length_takes_part(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.5]), (2, [1.0, 1.0, 0.0]), (50, [1.0, 2.0]), (51, [2.0, 1.0]),
            (100, [1e200, 1e200, 0.0]), (101, [1e-200, 1e-200, 1e-200]), (150, [5e-324, 0.0, 0.0]), (200, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lists(A.nearest(frame, ASKED))
    exact = {}
    for i, v in rows:
        if i % 50 == 0:
            cos = [(-sum(Fraction(a) * Fraction(b) for a, b in zip(v, w)) / _norm(v) / _norm(w), j) for j, w in rows if j != i and len(w) == len(v)]
            exact[i] = [(j, float(-c)) for c, j in sorted(cos)[:5]]
    assert set(got) == {0, 50, 100, 150}
    for i, near in got.items():
        assert [j for j, _ in near] == [j for j, _ in exact[i]]
        assert np.allclose([c for _, c in near], [c for _, c in exact[i]], rtol=0, atol=1e-15)


def _norm(v):
    """Root of the sum of squares as a fraction, near enough for doubles whatever the exponents."""
    top = max(abs(Fraction(x)) for x in v)
    return top * Fraction(math.sqrt(sum((Fraction(x) / top) ** 2 for x in v)))
