"""Embedding near-duplicates against all pairs."""

import numpy as np
import pandas as pd
import pytest

from rowtide.llm.embedding_dedup import calibrated, collision_counts, directions, grid_for, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """n_links and component of every row, by index."""
    n = len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def usable(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.float32(a[1]).astype(float), np.float32(b[1]).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    low, high = sorted((find(i), find(j)))
                    root[high] = low
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return [(r[0], links[i], low.get(find(i)), r[0] is None or low[find(i)] == r[0]) for i, r in enumerate(rows)]


def clustered(n, dims=64, labels=3, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] + rng.choice([0.02, 0.15, 0.3, 0.4]) * rng.standard_normal(dims)
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("settings", [{}, {"cell_rows": 60, "block_rows": 16}, {"block_rows": 16}, {"block_rows": 4}])
def test_equals_all_pairs(spark, settings):
    rows = clustered(400)
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(30)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), **settings)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0),
        (2, [1.0, 0.0], 0),
        (2, [2.0, 0.0], 0),
        (3, [1.0, 0.0], None),
        (4, None, 0),
        (5, [], 0),
        (6, [0.0, 0.0], 0),
        (7, [nan, 1.0], 0),
        (8, [inf, 1.0], 0),
        (9, [None, 1.0], 0),
        (10, [1.0, 0.0, 0.0], 0),
        (11, [1.0, 0.0], 1),
        (None, [1.0, 0.0], 0),
        (None, None, None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as n", "'y' as class_id", "'z' as line")
    got = sorted(map(tuple, near_vectors(frame).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_are_window_counts():
    rng = np.random.default_rng(1)
    q, s = rng.standard_normal((20, 5)), rng.standard_normal((50, 5))
    direct = (np.abs(q[:, None, :] - s[None, :, :]) <= 0.7).sum(2)
    assert (collision_counts(q, s, 0.7) == direct).all()


def test_calibration_keeps_the_recall():
    rule = calibrated(0.93, 24, 0.9995)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.standard_normal(x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z
    hit = (np.abs((x - y) @ directions(11, 64, 24)) <= rule.window).sum(1) >= rule.least
    assert hit.mean() > 0.998


def test_grid_grows_slowly():
    tables = [grid_for(n, 8192, calibrated(0.93, 24, 0.9995).distance, 0.9995).tables for n in (8192, 10**5, 10**6, 10**7)]
    assert tables[0] == 1 and tables == sorted(tables) and tables[-1] < 60


def test_a_copy_group_is_one_class(spark):
    frame = pd.DataFrame({"vec_id": range(5000), "embedding": [[1.0, 2.0]] * 5000, "label": 1})
    got = near_vectors(spark.createDataFrame(frame, SCHEMA)).agg({"n_links": "min", "component_id": "max"}).first()
    assert tuple(got) in {(4999, 0), (0, 4999)}
