"""Chi-square choice of features, and splits with repeated and missing keys."""

import math

import numpy as np
import pytest

from plumbline.operators.chi2 import best_features, chi2_scores
from plumbline.operators.split import add_folds, train_test_split


def test_chi2(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 600)
    x = np.stack([rng.poisson(2 + 3 * (y == 1)), rng.poisson(4, 600), rng.poisson(1 + y)], 1)
    rows = [(*map(float, r), None if i % 50 == 0 else "abc"[k], -1.0, 0.0) for i, (r, k) in enumerate(zip(x, y))]
    table = spark.createDataFrame(rows, "p double, q double, r double, y string, neg double, none double").repartition(4)
    known = np.arange(600) % 50 != 0
    x, y = x[known], y[known]
    observed = np.stack([x[y == k].sum(0) for k in range(3)])
    expected = np.outer(np.bincount(y) / len(y), x.sum(0))
    want = ((observed - expected) ** 2 / expected).sum(0)
    got = {r["feature"]: (r["chi2"], r["rank"]) for r in chi2_scores(table, "y").collect()}
    np.testing.assert_allclose([got[c][0] for c in "pqr"], want)
    assert got["neg"][0] is None and got["none"][0] is None and {got["neg"][1], got["none"][1]} == {4, 5}
    assert best_features(table, "y", 2) == sorted("pqr", key=lambda c: -got[c][0])[:2]


@pytest.mark.parametrize("rows_per_task", [20, 10_000])
def test_exact_split_with_repeated_and_missing_keys(spark, rows_per_task):
    rows = [(i, f"r{i}") for i in range(60)] + [(7, "same")] * 100 + [(None, f"n{i}") for i in range(50)] + [(None, "twin")] * 40
    table = spark.createDataFrame(rows, "k long, v string").repartition(5)
    for share in (0.1, 0.31, 0.5, 0.77):
        train, test = train_test_split(table, "k", share, seed=3, exact=True, rows_per_task=rows_per_task)
        assert test.count() == math.ceil(share * 250) and train.count() == 250 - math.ceil(share * 250)
        assert sorted((tuple(r) for r in train.unionByName(test).collect()), key=str) == sorted(rows, key=str)


def test_rows_without_a_key_are_drawn_apart(spark):
    table = spark.createDataFrame([(None, i) for i in range(1000)], "k long, v int")
    train, test = train_test_split(table, "k", 0.2)
    assert 140 < test.count() < 260 and train.count() + test.count() == 1000
    assert add_folds(table, "k", 5).select("fold").distinct().count() == 5
