"""Whitening against a plain eigendecomposition of the covariance."""

import math

import numpy as np
import pytest

from rowtide.llm.whitening import jacobi_davidson, minres, whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, components=16):
    """The contract's columns by forming the covariance: {vec_id: (deviation, [whitened up to sign])}, n, explained."""
    usable = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in usable})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(dims)]
    centred = np.array([[(n * x[k] - sums[k]) / n for k in range(dims)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in usable:
        scaled = [n * x[k] - sums[k] for k in range(dims)]
        out.append((i, sum(d * d for d in scaled), (np.array(scaled) / n) @ vectors / np.sqrt(values)))
    return out, n, values / np.trace(centred.T @ centred / n)


def vectors(rows, dims, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.float32(rng.standard_normal(dims) * np.linspace(2, 0.3, dims))]) for i in range(rows)]


def check(spark, rows, components=16, extra=(), **settings):
    expected, n, explained = plain(rows, components)
    got = whitened(spark.createDataFrame([(*r, 0) for r in [*rows, *extra]], SCHEMA), components=components, **settings).collect()
    k = len(explained)
    assert len(got) == len(rows) * k
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
        assert r.n == n and abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    signs = None
    for i, deviation, values in expected:
        mine = np.array([by_id[i][c][0].whitened for c in range(1, k + 1)])
        if signs is None:
            signs = np.sign(mine * values)
        assert {r.deviation for rs in by_id[i].values() for r in rs} == {deviation}
        assert np.abs(mine * signs - values).max() < 1e-8


def test_equals_eigendecomposition(spark):
    rows = vectors(300, 24)
    check(spark, rows + [(1000 + i, rows[5][1]) for i in range(80)])


def test_fewer_dimensions_than_components(spark):
    check(spark, vectors(50, 5))


def test_few_components_and_steps(spark):
    check(spark, vectors(200, 12), components=2, inner_steps=1, guard=1, largest_subspace=6)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(-1, None), (-2, []), (-3, [nan] * 6), (-4, [1.0, 2.0, 3.0, None, 5.0, 6.0]), (-5, [inf] + [0.0] * 5), (-6, [1.0, 2.0]), (-7, [3e38] + [0.0] * 5)]
    rows = vectors(40, 6)
    check(spark, rows, extra=odd)
    clashing = spark.createDataFrame([(*r, 0) for r in [*rows, *odd]], SCHEMA).selectExpr("*", "'a' as x", "'b' as n", "'c' as component", "'d' as node")
    assert whitened(clashing).count() == 240


def test_repeated_and_null_ids(spark):
    rows = vectors(30, 4)
    got = whitened(spark.createDataFrame([(None, v, 0) for _, v in rows] + [(7, rows[0][1], 0)] * 2, SCHEMA)).collect()
    assert len(got) == 32 * 4 and sum(r.vec_id is None for r in got) == 120
    assert len({tuple(r) for r in got if r.vec_id == 7}) == 4


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5])
def test_nothing_to_whiten(spark, rows):
    got = whitened(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))
    assert got.collect() == []
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(3) * 1e12)]) for i in range(20)]
    got = whitened(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))
    assert {r.deviation for r in got.collect()} == {None}
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(3) * 1e4)]) for i in range(20)]
    check(spark, rows)


def test_zero_variance_components_have_no_rows(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0, 2.0]) for i in range(35)]
    got = whitened(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2}


@pytest.mark.parametrize("dims, decay", [(30, 0.0), (120, 0.3), (300, 1.0)])
def test_solver(dims, decay):
    rng = np.random.default_rng(dims)
    a = rng.standard_normal((3 * dims, dims)) * np.arange(1, dims + 1) ** -decay
    v = a.T @ a / len(a)
    values, vectors = np.linalg.eigh(v)
    found = jacobi_davidson(lambda block: v @ block, dims, 16)
    assert np.abs(found.values - values[::-1][:16]).max() < 1e-13 * values[-1]
    assert np.abs(np.abs(np.einsum("ij,ij->j", found.vectors, vectors[:, ::-1][:, :16])) - 1).max() < 1e-12
    assert found.residual < 1e-12


def test_solver_with_repeated_eigenvalues():
    v = np.diag([4.0] * 5 + [1.0] * 30)
    found = jacobi_davidson(lambda block: v @ block, 35, 8)
    assert np.allclose(found.values, [4.0] * 5 + [1.0] * 3, atol=1e-13)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(8), atol=1e-13)


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    b = rng.standard_normal((20, 3))
    shifts = np.array([0.0, 0.5, -2.0])
    x = minres(lambda block: a @ block - block * shifts, b, 60, 1e-12)
    for j in range(3):
        assert np.allclose((a - shifts[j] * np.eye(20)) @ x[:, j], b[:, j], atol=1e-8)


def test_more_rows_than_are_worked_on_at_once(spark):
    from rowtide.llm.whitening import ROWS

    rows = vectors(2 * ROWS + 70, 3)
    nulls = [(-i, None) for i in range(1, 60)]
    mixed = [r for pair in zip(rows[:59], nulls) for r in pair] + rows[59:]
    frame = spark.createDataFrame([(*r, 0) for r in mixed], SCHEMA).coalesce(1)
    got = {(r.vec_id, r.component): r.deviation for r in whitened(frame).collect()}
    expected, _, _ = plain(rows)
    assert got == {(i, c): d for i, d, _ in expected for c in (1, 2, 3)}
