"""The four analyses end to end, on small tables of the shapes they expect."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from plumbline import flows
from plumbline.sources.tables import load_model


def test_order_volume(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(120):
        a, b, c = (float(v) for v in rng.uniform(20, 300, 3).round(3))
        rows.append((i % 5 + 1, a if i % 40 else None, b, c, a + b + c))
    rows += rows[:10]
    orders = spark.createDataFrame(rows, "`Week of.month` int, `Order type A` double, B double, C double, `Target (Total orders)` double")
    done = flows.order_volume(
        orders, "Order type A", folds=2, n_estimators=2,
        boosting={"loss": ["huber", "ls"], "learning_rate": [0.3], "subsample": [1.0, 3.0]},
        forest={"min_samples_split": [2], "n_estimators": [10], "max_depth": [5]},
    )
    table = {r["candidate"]: r for r in done.boosted.table.collect()}
    assert done.boosted.best_params == {"learning_rate": 0.3, "loss": "huber", "subsample": 1.0}
    assert sum(r["error"] is not None for r in table.values()) == 3
    scores = {r["model"]: r for r in done.scores.collect()}
    assert set(scores) == {"boosted", "forest"} and scores["forest"]["r2"] > 0.5
    shares = [r["importance"] for r in done.importances.where("model = 'boosted'").collect()]
    assert len(shares) == 4 and sum(shares) == pytest.approx(1)
    assert done.predictions.columns == ["row_key", "label", "boosted", "forest"]
    assert 10 <= done.predictions.count() <= 45


def test_credit(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        h, x = rng.uniform(100, 9_000), rng.normal()
        rows.append(("m" if i % 3 else "f", float(h), float(x), int(rng.random() < 1 / (1 + np.exp(-2 * x)))))
    rows.append(("f", None, 0.0, 1))
    table = spark.createDataFrame(rows + rows[:20], "gender string, hoehe double, x double, kredit int")
    path = str(tmp_path / "best")
    done = flows.credit(table, grid={"intercept_scaling": [1, 3], "max_iter": [50]}, folds=2, save_to=path)
    terms = {(r["model"], r["term"]): r["weight"] for r in done.weights.collect()}
    assert len(terms) == 8 and terms["l1", "x"] > 0.5 and terms["l2", "x"] > 0.5
    scores = {r["model"]: r for r in done.scores.collect()}
    assert done.better == ("l1" if scores["l1"]["accuracy"] > scores["l2"]["accuracy"] else "l2")
    assert done.l2.best_params == {"intercept_scaling": 1, "max_iter": 50}
    assert len(load_model(PipelineModel, path).stages) in (1, 3)


@pytest.fixture(scope="module")
def policies(spark):
    rng = np.random.default_rng(2)
    ages = ["< 1 Year", "1-2 Year", "> 2 Years"]
    rows = []
    for i in range(600):
        damage, insured = rng.integers(0, 2), rng.integers(0, 2)
        hit = int(rng.random() < (0.7 if damage and not insured else 0.05))
        rows.append((
            i, ["Male", "Female"][i % 2], int(rng.integers(20, 80)), 1, float(rng.integers(0, 50)), int(insured),
            ages[int(rng.integers(0, 3))], ["No", "Yes"][damage], float(rng.uniform(2_000, 60_000)), 26.0, int(rng.integers(10, 300)), hit,
        ))
    return spark.createDataFrame(
        rows,
        "id long, Gender string, Age int, Driving_License int, Region_Code double, Previously_Insured int, "
        "Vehicle_Age string, Vehicle_Damage string, Annual_Premium double, Policy_Sales_Channel double, Vintage int, Response int",
    )


def test_insurance(policies):
    done = flows.insurance(
        policies, folds=2, forest={"n_estimators": [10], "max_depth": [None, 4], "min_samples_split": [5]}
    )
    scores = done.logit_scores.collect()
    assert [r["C"] for r in scores] == [0.1, 1.0, 10.0] and max(r["auc"] for r in scores) > 0.75
    assert done.forest_auc.first()["auc"] > 0.75
    for curve in (done.best_curve, done.forest_curve):
        last = curve.orderBy("threshold").where("threshold IS NOT NULL").first()
        assert (last["fpr"], last["tpr"]) == (1.0, 1.0)


def test_submission(policies, tmp_path):
    encoded = flows.encode_insurance(policies)
    train, test = encoded.where("id < 450"), encoded.where("id >= 450").drop("Response")
    sheet = test.selectExpr("id", "0.0D AS Response")
    done = flows.submission(train, test, sheet, str(tmp_path / "sheet"), n_estimators=5, max_depth=4, max_bin=64)
    rows = done.sheet.collect()
    assert done.sheet.columns == ["id", "Response"] and {r["id"] for r in rows} == set(range(450, 600))
    assert len({r["Response"] for r in rows}) > 2 and all(r["Response"] is not None for r in rows)
    assert done.held_out_auc.first()["auc"] > 0.75
