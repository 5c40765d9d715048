"""Model queries fit the reference's number of trees; the scorer's rounds from counted cells."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from bindings import QUERIES, models
from plumbline.ml import cells
from plumbline.ml.scorer import BoostedScorer
from plumbline.ml.trees import boosted_scorer
from plumbline.operators.features import features_and_label
from plumbline.sources.tables import load_model, save_model


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    """A folder with a small ``lineitem`` and ``part``."""
    folder = tmp_path_factory.mktemp("sales")
    rng = np.random.default_rng(17)
    rows = [
        (i // 4, i % 4, i % 20, i % 7, float(rng.integers(1, 51)), float(rng.integers(900, 9000)),
         float(rng.integers(0, 11)) / 100, float(rng.integers(0, 9)) / 100, "RAN"[int(rng.integers(0, 3))])
        for i in range(600)
    ]
    schema = (
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    )
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(i, 900.0 + 5 * i) for i in range(20)]
    spark.createDataFrame(parts, "p_partkey long, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def fitted(monkeypatch, spark, name, folder):
    """The model that a query fits, and its rows."""
    kept, plain = [], models.fit

    def noted(*args):
        kept.append(plain(*args))
        return kept[-1]

    monkeypatch.setattr(models, "fit", noted)
    rows = QUERIES[name](spark, folder).collect()
    return kept[0], rows


def test_the_boosted_regression_has_all_its_trees(spark, monkeypatch, sales):
    model, rows = fitted(monkeypatch, spark, "gbt_regression", sales)
    assert model.getNumTrees == 100 and {t.depth for t in model.trees} <= {1, 2, 3}
    assert rows[0]["r2"] > 0.9


def test_the_scorer_has_all_its_trees(spark, monkeypatch, sales):
    asked, plain = [], BoostedScorer._fit
    monkeypatch.setattr(BoostedScorer, "_fit", lambda self, rows: asked.append(self) or plain(self, rows))
    model, rows = fitted(monkeypatch, spark, "gbt_scoring", sales)
    assert (asked[0].getMaxIter(), asked[0].getMaxDepth(), asked[0].getMaxBins()) == (3000, 10, 3500)
    trees = model.stages[1].trees
    assert len(trees) == 3001 and max(t.depth for t in trees) > 5
    assert 0 <= rows[0]["auc"] <= 1


@pytest.fixture(scope="module")
def holes(spark):
    """Missing values of ``a`` act like large ones, those of ``b`` like small ones; ``d`` is always the same."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(1500):
        a, b, c = (float(np.round(v, 2)) for v in rng.random(3))
        y = (a > 0.6) + 2.0 * (b > 0.5) + 0.3 * math.sin(9 * c) + 0.2 * float(rng.random())
        rows.append((i, None if a > 0.6 and i % 2 else a, None if b <= 0.5 and i % 3 == 0 else b, c, 4.0, y))
    return vectors(spark, rows)


def vectors(spark, rows):
    table = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double")
    return features_and_label(table, "y", ["a", "b", "c", "d"], keep=["id"], missing="keep").repartition(3)


def scores(model, rows):
    return [r["prediction"] for r in model.transform(rows).orderBy("id").collect()]


def test_trees_from_cells_are_those_from_rows(spark, holes, monkeypatch, tmp_path):
    scorer = boosted_scorer(n_estimators=9, learning_rate=0.3, max_depth=4, max_bin=128)
    model = scorer.fit(holes)
    monkeypatch.setattr(cells, "MAX_PAIRS", -1)
    other = scorer.fit(holes)
    mine, theirs = model.stages[1], other.stages[1]
    assert isinstance(mine, cells.SummedTrees) and not isinstance(theirs, cells.SummedTrees)
    assert [(t.numNodes, t.depth) for t in mine.trees] == [(t.numNodes, t.depth) for t in theirs.trees]
    np.testing.assert_allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    places = [None, -50.0, -5.0, -1.0, -0.1, 0.005, 0.5, 0.601, 1.2, 50.0]
    unseen = vectors(spark, [(i, places[i // 10], places[i % 10], 0.5, places[i % 7], 0.0) for i in range(100)])
    again = load_model(PipelineModel, save_model(model, str(tmp_path / "model")))
    for rows in (holes, unseen):
        np.testing.assert_allclose(scores(model, rows), scores(other, rows), atol=1e-9)
        np.testing.assert_allclose(scores(model, rows), scores(again, rows), atol=1e-9)


def test_bins_of_many_values_hold_about_equal_rows(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in rng.random(3000)] + [0.5] * 1000 + [math.nan] * 50
    table = spark.createDataFrame([(v, float(i % 3), 0.0) for i, v in enumerate(values)], "x double, z double, y double")
    rows = features_and_label(table, "y", ["x", "z"], missing="keep")
    bins = cells.bins_of(rows, [20, 20])
    assert 10 <= bins[0].missing <= 20 and bins[1].cuts.tolist() == [0.5, 1.5] and bins[0].least == min(values)
    counts = cells.counted(rows, bins)
    known = np.array(values[:4000])
    want = np.bincount(np.searchsorted(bins[0].cuts, known, side="left"), minlength=bins[0].missing).tolist()
    assert counts.rows[0].tolist() == [*want, 50] and sorted(want)[-2] <= 2 * 200
    assert counts.rows[1].tolist() == [1350, 1350, 1350, 0] and sum(counts.pairs[0, 1][2]) == 4050


@pytest.mark.parametrize("row", [(1.0, None), (1.0, math.nan), (1.0, math.inf), (math.inf, 1.0)])
def test_endless_features_and_labels_without_a_number_are_errors(spark, row):
    table = spark.createDataFrame([(float(i), 1.0) for i in range(9)] + [row], "x double, y double")
    with pytest.raises(ValueError):
        boosted_scorer(n_estimators=1).fit(features_and_label(table, "y", ["x"], missing="keep"))
