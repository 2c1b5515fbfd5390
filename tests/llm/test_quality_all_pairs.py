"""The quality model is fitted on every labelled row and every pair of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm.common import fit_logistic
from rowtide.llm.quality_ranker import features, fit_quality, neighbours, quantile_cut

WORDS = ["alpha", "beta", "Gamma", "42", "delta|", "$x#", "EPS", "zeta!", "of", "the"]


def texts_of(labels, seed):
    rng = np.random.default_rng(seed)
    odd, plain = np.array([1, 2, 2, 5, 5, 5, 4, 5, 2, 2]) / 33, np.array([4, 4, 2, 2, 1, 1, 2, 1, 8, 8]) / 33
    return [" ".join(rng.choice(WORDS, rng.integers(3, 30), p=plain if k else odd)) for k in labels]


def test_every_row_and_pair_counts(spark, documents):
    """More rows than the 20,000 and more pairs than the 60,000 that were looked at before."""
    label = np.array([0] * 60 + [1] * 21_000)
    texts = texts_of(label, 3)
    table = spark.createDataFrame([(i, int(k), 0) for i, k in enumerate(label)], "doc_id long, quality int, toxic int")
    docs = documents(list(enumerate_rows(texts)))
    model = fit_quality(docs, table, buckets=5, remainder=9, l2=1e-3)
    rows = np.array([features(t) for t in texts])
    assert np.allclose(model.centre, rows.mean(0), atol=1e-12)
    assert np.allclose(model.scale, np.maximum(rows.std(0), 0.02), atol=1e-12)
    z = (rows - rows.mean(0)) / np.maximum(rows.std(0), 0.02)
    raw = z @ model.weights
    good, bad = z[label == 1], z[label == 0]
    wrong = 1 / (1 + np.exp(raw[label == 1][:, None] - raw[label == 0][None, :]))
    slope = (wrong.sum(0) @ bad - wrong.sum(1) @ good) / wrong.size + 1e-3 * model.weights
    assert np.abs(model.weights).max() > 0.1 and np.abs(slope).max() < 1e-6
    assert model.cut == pytest.approx(quantile_cut(raw, np.ones(len(raw)), 60 / len(raw)), abs=1e-9)
    steep = fit_logistic((raw - model.cut)[:, None], label.astype(float), l2=1e-4)[0]
    assert model.steep == pytest.approx(np.clip(steep, 0.05, 20), rel=1e-6)


def enumerate_rows(texts):
    return ((i, t, "en", "a") for i, t in enumerate(texts))


def test_few_rows_equal_the_plain_fit_of_all_pairs(spark, documents):
    label = np.array([0, 1] * 40)
    texts = texts_of(label, 5)
    table = spark.createDataFrame([(i, int(k), 0) for i, k in enumerate(label)], "doc_id long, quality int, toxic int")
    model = fit_quality(documents(list(enumerate_rows(texts))), table, buckets=5, remainder=9)
    z = (np.array([features(t) for t in texts]) - model.centre) / model.scale
    apart = (z[label == 1][:, None, :] - z[label == 0][None, :, :]).reshape(-1, z.shape[1])
    won = np.repeat([1.0, 0.0], len(apart))
    assert np.allclose(model.weights, fit_logistic(np.concatenate([apart, -apart]), won, l2=1e-4)[:-1], atol=1e-4)


def test_one_row_for_an_id_that_repeats(spark, documents):
    rows = [(1, "b b", "en", "a"), (1, "a", "en", "a"), (2, None, "en", "a"), (3, "c d e", "en", "a"), (None, "x", "en", "a")]
    table = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (2, 1, 0), (3, 1, 0), (None, 0, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    once = fit_quality(documents(rows), table, buckets=5, remainder=9)
    again = fit_quality(documents(rows[::-1] + rows), table, buckets=5, remainder=9)
    assert np.allclose(once.centre, again.centre) and np.allclose(once.weights, again.weights) and once.cut == pytest.approx(again.cut)
    assert any(np.allclose(once.centre, np.mean([features(t) for t in (first, None, "c d e")], 0)) for first in ("a", "b b"))


def test_neighbours_by_rank(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.standard_normal(300), [0.5] * 50, [-1e6, 1e6, 0.5 + 1e-15, 0.0, -0.0]])
    scores = spark.createDataFrame([(float(v),) for v in values], "raw double")
    ordered = np.sort(values)
    for k in (1, 2, 150, 200, 240, 250, 300, len(values) - 1):
        assert neighbours(scores, k) == (ordered[k - 1], ordered[k])
    assert neighbours(scores.where(F.col("raw") == 0.5), 7) == (0.5, 0.5)
