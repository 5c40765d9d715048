"""The boosted scorer: missing values, columns per tree; searches that outlive a failing candidate."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plumbline import flows
from plumbline.ml.scorer import MissingSides, masks
from plumbline.ml.search import fit, grid_search, importances
from plumbline.ml.trees import boosted_regressor, boosted_scorer, forest_regressor
from plumbline.operators.features import features_and_label
from plumbline.operators.split import add_folds
from plumbline.sources.tables import load_model, save_model


@pytest.fixture(scope="module")
def gaps(spark):
    """Missing values of ``a`` act like large ones, those of ``b`` like small ones."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(2000):
        a, b, c = (float(v) for v in rng.random(3))
        y = (a > 0.6) + 2.0 * (b > 0.5) + 0.01 * float(rng.random())
        rows.append((i, None if a > 0.6 and i % 2 else a, None if b <= 0.5 and i % 3 == 0 else b, c, float(y)))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(4).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_missing_values_go_to_the_side_that_fits(gaps, spark, tmp_path, share):
    train = features_and_label(gaps, "y", ["a", "b", "c"], keep=["id"], missing="keep")
    model = fit(boosted_scorer(n_estimators=14, learning_rate=0.5, max_depth=2, max_bin=64, colsample_bytree=share), train)
    scored = model.transform(train).select("id", "label", "prediction").toPandas()
    lost = gaps.where("a IS NULL OR b IS NULL").toPandas().id
    off = np.abs(scored.label - scored.prediction)
    assert off.mean() < 0.08 and off[scored.id.isin(lost)].mean() < 0.08  # a few bins straddle the cuts
    shares = {r["feature"]: r["importance"] for r in importances(model, ["a", "b", "c"], spark).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and shares["b"] > shares["a"] > 10 * shares["c"]
    save_model(model, str(tmp_path / "model"))
    again = load_model(PipelineModel, str(tmp_path / "model")).transform(train).select("id", "prediction").toPandas()
    assert again.set_index("id").prediction.to_dict() == scored.set_index("id").prediction.to_dict()


def test_sides(spark):
    rows = [(1.0, None, 5.0), (3.0, 2.0, 5.0), (None, 4.0, 5.0)]
    table = spark.createDataFrame([(*r, 0.0) for r in rows], "a double, b double, c double, y double")
    vectors = features_and_label(table, "y", ["a", "b", "c"], missing="keep")
    sides = MissingSides.fitted(vectors)
    assert sides.owners() == [0, 1, 2, 0, 1]
    made = [list(r[0]) for r in sides.transform(vectors).select("sided_features").collect()]
    assert made[0][1] < 2.0 and made[0][4] > 4.0 and made[2][0] < 1.0 and made[2][3] > 3.0
    assert [m[2] for m in made] == [5.0] * 3 and made[1] == [3.0, 2.0, 5.0, 3.0, 2.0]
    later = features_and_label(spark.createDataFrame([(1.0, 1.0, None, 0.0)], table.schema), "y", ["a", "b", "c"], missing="keep")
    assert list(sides.transform(later).first()["sided_features"])[2] < 5.0
    with pytest.raises(ValueError):
        MissingSides.fitted(vectors.limit(0))


def test_every_tree_stays_in_its_mask(gaps):
    train = features_and_label(gaps, "y", ["a", "b", "c"], keep=["id"], missing="keep")
    scorer = boosted_scorer(n_estimators=9, learning_rate=0.3, max_depth=3, max_bin=32, colsample_bytree=0.48)
    model = scorer.fit(train)
    owners = model.stages[0].owners()
    chosen = masks(owners, 0.48, 9, 41)
    assert len(model.stages[1].trees) == 10 and model.stages[1].trees[0].depth == 0
    used = []
    for mask, tree in zip(chosen, model.stages[1].trees[1:]):
        places = set(np.flatnonzero(tree.featureImportances.toArray()))
        assert places <= set(np.flatnonzero(mask)) and len({owners[i] for i in np.flatnonzero(mask)}) == 1
        used.append(frozenset(owners[i] for i in places))
    assert len(set(used)) > 1


def test_submission_with_a_missing_premium(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(500):
        damage, insured = int(rng.integers(0, 2)), int(rng.integers(0, 2))
        premium = None if i % 5 == 0 else float(rng.uniform(2_000, 60_000))
        hit = int(rng.random() < (0.8 if damage and not insured else 0.05))
        rows.append((i, int(rng.integers(20, 80)), int(rng.integers(0, 3)), insured, damage, premium, hit))
    schema = "id long, Age int, Vehicle_Age int, Previously_Insured int, Vehicle_Damage int, Annual_Premium double, Response int"
    table = spark.createDataFrame(rows, schema)
    train, test = table.where("id < 400"), table.where("id >= 400").drop("Response")
    sheet = test.selectExpr("id", "0.0D AS Response")
    done = flows.submission(train, test, sheet, str(tmp_path / "sheet"), n_estimators=4, max_depth=3, max_bin=32, learning_rate=0.3)
    scored = done.sheet.collect()
    assert {r["id"] for r in scored} == set(range(400, 500)) and all(r["Response"] is not None for r in scored)
    assert done.held_out_auc.first()["auc"] > 0.7


def test_search_outlives_a_fit_that_fails(gaps):
    train = add_folds(features_and_label(gaps.na.fill(0.0), "y", ["a", "b", "c"], keep=["id"]), "id", 2)
    found = grid_search(forest_regressor, [{"n_estimators": 0, "max_depth": 2}, {"n_estimators": 2, "max_depth": 2}], train, "r2", folds=2)
    rows = {r["candidate"]: r for r in found.table.collect()}
    assert rows[0]["mean_score"] is None and rows[0]["rank"] == 2 and rows[0]["error"]
    assert rows[1]["rank"] == 1 and rows[1]["error"] is None and found.best_params["n_estimators"] == 2
    assert found.best_model.getNumTrees == 2


def test_search_outlives_a_rate_that_cannot_be(gaps):
    train = add_folds(features_and_label(gaps.na.fill(0.0), "y", ["a", "b", "c"], keep=["id"]), "id", 2)
    grid = [{"learning_rate": r, "n_estimators": 2} for r in (-1.0, 0.3)]
    found = grid_search(boosted_regressor, grid, train, "r2", folds=2)
    rows = {r["candidate"]: r for r in found.table.collect()}
    assert [rows[i]["rank"] for i in (0, 1)] == [2, 1] and rows[0]["mean_score"] is None


def test_jobs_of_a_failing_candidate_end_alone(gaps):
    """The other candidate's jobs carry another tag and run on."""
    train = add_folds(features_and_label(gaps.na.fill(0.0), "y", ["a", "b", "c"], keep=["id"]), "id", 2)

    def make(bad):
        model = forest_regressor(n_estimators=2, max_depth=2)
        if not bad:
            return model

        class Failing:
            def fit(self, rows):
                rows.select(F.assert_true(F.lit(False))).collect()

        return Failing()

    found = grid_search(make, [{"bad": True}, {"bad": False}, {"bad": True}], train, "r2", folds=2)
    rows = {r["candidate"]: r for r in found.table.collect()}
    assert [rows[i]["rank"] for i in range(3)] == [2, 1, 3] and rows[1]["mean_score"] > 0
    with pytest.raises(ValueError, match="no candidate"):
        grid_search(make, [{"bad": True}], train, "r2", folds=2)
