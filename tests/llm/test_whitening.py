"""Whitening against exact sums and a plain eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import DATA

from tillmart.llm import queries, whitening


def given(spark, rows):
    schema = "vec_id long, embedding array<double>, n string, component int"
    return spark.createDataFrame([(*r, "x", 7) for r in rows], schema).repartition(3)


def usable(rows):
    return [(k, v) for k, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]


def check(found, rows, most=32, offset=1_000_000):
    """Rows of one length, whose covariance has different eigenvalues."""
    kept = usable(rows)
    x = np.array([[int(np.floor(64 * c)) + offset for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    distances = n * x - sums
    centred = distances.astype(float) / n
    _, lengths, vectors = np.linalg.svd(centred, full_matrices=False)
    values, vectors = lengths**2 / n, vectors.T
    count = min(most, int((lengths > lengths[0] * 1e-12).sum()))
    by_row = {}
    for row in found:
        by_row.setdefault((row.vec_id, row.deviation), {}).setdefault(row.component, []).append(row)
    deviations = (distances * distances).sum(axis=1)
    white = centred @ vectors[:, :count] / np.sqrt(values[:count])
    signs = {}
    assert len(found) == n * count
    for at, (key, _) in enumerate(kept):
        rows_of = by_row[key, int(deviations[at])]
        assert sorted(rows_of) == list(range(1, count + 1))
        for component, told in rows_of.items():
            for row in told:
                assert row.n == n
                assert row.explained == pytest.approx(values[component - 1] / values.sum(), rel=1e-9)
                assert row.identity_error < 1e-9
                wanted = white[at, component - 1]
                sign = signs.setdefault(component, np.sign(row.whitened * wanted) if abs(wanted) > 1e-3 else None)
                if sign is None:
                    signs.pop(component)
                    assert abs(row.whitened) == pytest.approx(abs(wanted), abs=1e-6)
                else:
                    assert row.whitened == pytest.approx(sign * wanted, abs=1e-6)


def drawn(count, dimension, seed=1, spread=3.0):
    draw = np.random.default_rng(seed)
    mixing = draw.standard_normal((dimension, dimension)) * np.geomspace(1, spread, dimension)
    return [(k, (draw.standard_normal(dimension) @ mixing).tolist()) for k in range(count)]


def test_against_eigenvectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = drawn(200, 6)
    rows += [(3, rows[3][1]), (3, rows[4][1]), (900, [nan, *[1.0] * 5]), (901, [1.0, inf, *[0.0] * 4])]
    rows += [(902, None), (903, []), (904, [None, *[1.0] * 5]), (905, [0.0] * 6)]
    check(whitening.whitened_rows(given(spark, rows)).collect(), rows)


def test_only_the_first_components(spark):
    rows = drawn(150, 8, seed=2)
    found = whitening.whitened_rows(given(spark, rows), most_components=3).collect()
    assert {row.component for row in found} == {1, 2, 3}
    check(found, rows, most=3)


def test_ill_conditioned_rows(spark):
    rows = drawn(300, 5, seed=3, spread=1e4)
    check(whitening.whitened_rows(given(spark, rows)).collect(), rows)


def test_directions_without_variance_are_no_components(spark):
    rows = [(k, [*v, 5.0, float(np.floor(64 * v[1]) / 64)]) for k, v in drawn(60, 3, seed=4)]
    found = whitening.whitened_rows(given(spark, rows)).collect()
    assert {row.component for row in found} == {1, 2, 3}
    check(found, rows)


def test_fewer_rows_than_dimensions(spark):
    rows = drawn(4, 9, seed=5)
    found = whitening.whitened_rows(given(spark, rows)).collect()
    assert {row.component for row in found} == {1, 2, 3}
    check(found, rows)


def test_no_direction_at_all(spark):
    assert whitening.whitened_rows(given(spark, [])).collect() == []
    assert whitening.whitened_rows(given(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whitened_rows(given(spark, [(n, [1.0, 2.0]) for n in range(9)])).collect() == []


def test_lengths_are_fitted_apart_and_null_ids_stay(spark):
    short, long = drawn(40, 2, seed=6), drawn(50, 4, seed=7)
    long = [(None, long[0][1]), *[(k + 100, v) for k, v in long[1:]]]
    found = whitening.whitened_rows(given(spark, short + long)).collect()
    check([row for row in found if row.n == 40], short)
    check([row for row in found if row.n == 50], long)


def test_exact_integers_beyond_a_long(spark):
    rows = [(k, [c * 1e9 for c in v]) for k, v in drawn(30, 3, seed=8)]
    found = whitening.whitened_rows(given(spark, rows)).collect()
    assert {row.deviation for row in found} == {None} and all(r.identity_error < 1e-9 for r in found)
    with pytest.raises(Exception, match="too large"):
        whitening.whitened_rows(given(spark, [(1, [1e300]), (2, [1.0])])).collect()


def test_shifted_factor_of_a_singular_matrix():
    rows = np.random.default_rng(1).standard_normal((20, 3))
    gram = (lambda a: a.T @ a)(np.hstack([rows, rows[:, :1]]))
    r = whitening.shifted_cholesky(gram, 20)
    assert np.allclose(r.T @ r, gram, atol=1e-9) and np.allclose(np.tril(r, -1), 0)
    wide = np.random.default_rng(2).standard_normal((7, 4))
    assert np.allclose(whitening.solved(wide, r[:4]) @ r[:4], wide, rtol=1e-4)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    check(queries.op12_whitening(spark, DATA).collect(), rows)
