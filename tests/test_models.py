import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plumbline.ml import clusters, search
from plumbline.ml.huber import HuberBoosting
from plumbline.ml.logistic import PenalisedLogit, weights
from plumbline.ml.search import better_of, grid_search, importances, kept_even, parameter_grid, with_score
from plumbline.ml.trees import boosted_regressor, boosted_scorer, forest_classifier, forest_regressor
from plumbline.operators.features import features_and_label
from plumbline.operators.metrics import regression_metrics, roc_auc
from plumbline.operators.split import add_folds
from plumbline.sources.tables import load_model, save_model


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1.0, 2.0, 0.5] + [0.0, 1.0, 0.0]
    p = 1 / (1 + np.exp(-(x @ [1.0, -0.7, 0.0] + 0.8)))
    y = (rng.random(400) < p).astype(int)
    z = 3 * x[:, 0] - x[:, 1] ** 2 + rng.normal(size=400) * 0.1
    z[:8] += 100
    rows = [(i, *map(float, r), int(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, z))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int, z double").repartition(4).cache()
    yield df, x, y, z
    df.unpersist()


def loss(w, x, y, c, penalty, bias_in):
    s = np.where(y == 1, 1, -1)
    fit = c * np.logaddexp(0, -s * (x @ w)).sum()
    part = w if bias_in else w[:-1]
    return fit + (np.abs(part).sum() if penalty == "l1" else 0.5 * part @ part)


def newton_l2(x, y, c, bias_in):
    w = np.zeros(x.shape[1])
    keep = np.ones(len(w))
    if not bias_in:
        keep[-1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = c * x.T @ (p - y) + keep * w
        h = c * (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        w = w - np.linalg.solve(h, g)
    return w


@pytest.mark.parametrize("solver,scale,c", [("lbfgs", 1.0, 1.0), ("liblinear", 1.0, 0.1), ("liblinear", 3.0, 10.0)])
def test_l2_logit_is_the_optimum(data, solver, scale, c):
    df, x, y, _ = data
    train = features_and_label(df, "y", ["a", "b", "c"])
    w, b = weights(PenalisedLogit(solver=solver, intercept_scaling=scale, C=c).fit(train))
    constant = scale if solver == "liblinear" else 1.0
    best = newton_l2(np.column_stack([x, np.full(len(x), constant)]), y, c, solver == "liblinear")
    np.testing.assert_allclose([*w, b], [*best[:-1], constant * best[-1]], atol=1e-4)


def test_l1_logit_cannot_be_improved(data):
    df, x, y, _ = data
    train = features_and_label(df, "y", ["a", "b", "c"])
    w, b = weights(PenalisedLogit(penalty="l1", solver="liblinear", C=0.05).fit(train))
    full = np.column_stack([x, np.ones(len(x))])
    at = np.array([*w, b])
    base = loss(at, full, y, 0.05, "l1", True)
    for i in range(4):
        for d in (-1e-3, 1e-3):
            moved = at.copy()
            moved[i] += d
            assert loss(moved, full, y, 0.05, "l1", True) >= base - 1e-7
    assert w[2] == 0


def test_logit_rejects_what_cannot_be_fitted():
    with pytest.raises(ValueError):
        PenalisedLogit(penalty="l3")
    with pytest.raises(ValueError):
        PenalisedLogit(penalty="l1", solver="lbfgs")


def test_saved_model_predicts_the_same(data, tmp_path):
    df, *_ = data
    train = features_and_label(df, "y", ["a", "b", "c"], keep=["id"])
    model = PenalisedLogit(penalty="l1", solver="liblinear").fit(train)
    again = load_model(PipelineModel, save_model(model, str(tmp_path / "m")))
    one = {r["id"]: r["score"] for r in with_score(model.transform(train)).collect()}
    two = {r["id"]: r["score"] for r in with_score(again.transform(train)).collect()}
    assert one == two


def test_parameter_grid_order():
    assert parameter_grid({"b": [1, 2], "a": ["x", "y"]}) == [
        {"a": "x", "b": 1}, {"a": "x", "b": 2}, {"a": "y", "b": 1}, {"a": "y", "b": 2},
    ]


def test_grid_search_lists_failures_last_and_first_wins_ties(data):
    df, *_ = data
    train = add_folds(features_and_label(df, "y", ["a", "b", "c"], keep=["id"]), "id", 3)
    grid = parameter_grid({"penalty": ["l3", "l2"], "intercept_scaling": [1.0, 3.0]})
    found = grid_search(PenalisedLogit, grid, train, "accuracy", folds=3)
    rows = {r["candidate"]: r for r in found.table.collect()}
    assert [rows[i]["rank"] for i in range(4)] == [3, 1, 4, 2]
    assert rows[0]["mean_score"] is None and "l3" in rows[0]["error"]
    assert rows[1]["mean_score"] == rows[3]["mean_score"]
    assert found.best_params == json.loads(rows[1]["params"])
    assert 0.5 < found.best_score <= 1


def test_grid_search_without_a_valid_candidate_raises(data):
    df, *_ = data
    train = add_folds(features_and_label(df, "y", ["a"], keep=["id"]), "id", 3)
    with pytest.raises(ValueError, match="no candidate"):
        grid_search(PenalisedLogit, [{"penalty": "l3"}], train, "accuracy", folds=3)


def test_tie_goes_to_the_second_model():
    assert better_of(("l1", None, 0.8), ("l2", None, 0.8))[0] == "l2"
    assert better_of(("l1", None, 0.9), ("l2", None, 0.8))[0] == "l1"


def test_tree_parameters():
    with pytest.warns(UserWarning, match="30"):
        model = forest_regressor(n_estimators=10, max_depth=100, min_samples_split=4)
    assert (model.getNumTrees(), model.getMaxDepth(), model.getMinInstancesPerNode()) == (10, 30, 2)
    assert forest_classifier().getMaxDepth() == 30
    for bad in ({"subsample": 3.0}, {"loss": "ls"}):
        with pytest.raises(ValueError):
            boosted_regressor(**bad)
    scorer = boosted_scorer()
    assert (scorer.getMaxIter(), scorer.getMaxDepth(), scorer.getMaxBins()) == (3000, 10, 3500)
    assert (scorer.getStepSize(), scorer.getMinInstancesPerNode(), scorer.getFeatureSubsetStrategy()) == (0.01567, 6, "0.48")


def test_forests_learn_and_importances_sum_to_one(spark, data):
    df, *_ = data
    train = features_and_label(df.where("z < 50"), "z", ["a", "b", "c"])
    model = forest_regressor(n_estimators=10, max_depth=6).fit(train)
    assert regression_metrics(model.transform(train)).first()["r2"] > 0.8
    shares = {r["feature"]: r["importance"] for r in importances(model, ["a", "b", "c"], spark).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and shares["c"] == min(shares.values())
    flags = features_and_label(df, "y", ["a", "b", "c"])
    auc = roc_auc(with_score(forest_classifier(n_estimators=10, max_depth=5).fit(flags).transform(flags))).first()["auc"]
    assert auc > 0.8


def huber_by_hand(x, y, rate, rounds, alpha=0.9):
    """One-split boosting on a single column, for trees of depth 1."""
    f = np.full(len(y), np.quantile(y, 0.5))
    for _ in range(rounds):
        r = y - f
        delta = np.quantile(np.abs(r), alpha)
        g = np.clip(r, -delta, delta)
        best = None
        for cut in (np.unique(x)[:-1] + np.unique(x)[1:]) / 2:
            left = x <= cut
            cost = ((g[left] - g[left].mean()) ** 2).sum() + ((g[~left] - g[~left].mean()) ** 2).sum()
            if best is None or cost < best[0] - 1e-9:
                best = (cost, left)
        for side in (best[1], ~best[1]):
            m = np.quantile(r[side], 0.5)
            f[side] += rate * (m + np.clip(r[side] - m, -delta, delta).mean())
    return f


def test_huber_boosting_equals_a_hand_computation(spark):
    rng = np.random.default_rng(5)
    x = np.repeat(np.arange(8.0), 10)
    y = np.where(x > 4, 5.0, 1.0) + x * 0.3 + rng.normal(size=80) * 0.05
    y[3] = 500.0
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x double, y double")
    train = features_and_label(df.repartition(3), "y", ["x"], keep=["id"])
    model = HuberBoosting(learning_rate=0.3, n_estimators=9, max_depth=1).fit(train)
    found = {r["id"]: r["prediction"] for r in model.transform(train).collect()}
    np.testing.assert_allclose([found[i] for i in range(80)], huber_by_hand(x, y, 0.3, 9), rtol=1e-9)


def test_huber_boosting_saves_and_loads(data, tmp_path):
    df, *_ = data
    train = features_and_label(df, "z", ["a", "b", "c"], keep=["id"])
    model = boosted_regressor(loss="huber", n_estimators=2, subsample=0.7).fit(train)
    again = load_model(PipelineModel, save_model(model, str(tmp_path / "h")))
    both = [sorted((r["id"], r["prediction"]) for r in m.transform(train).collect()) for m in (model, again)]
    assert both[0] == both[1]


def test_kmeans_centres_and_cost(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.1, size=(30, 2)) for c in (0, 10, 20, 30, 40, 50)])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "id long, v array<double>")
    wide = df.select("id", F.col("v")[0].alias("x.1"), F.col("v")[1].alias("y"))
    for vectors in (clusters.cluster_vectors(df, ["v"], keep=["id"]), clusters.cluster_vectors(wide, ["x.1", "y"], keep=["id"])):
        model = clusters.fit_kmeans(vectors)
        rows = model.transform(vectors).join(df, "id")
        centers = clusters.assigned_centers(rows, "prediction", "v")
        got = {(r["cluster"], r["dim"]): r["value"] for r in centers.collect()}
        want = {(r["cluster"], r["dim"]): r["value"] for r in clusters.model_centers(model, spark).collect()}
        assert got == pytest.approx(want)
        cost = clusters.inertia(df, "v", centers).first()["inertia"]
        assert cost == pytest.approx(model.summary.trainingCost, rel=1e-6)
        assert cost < 10


def test_kept_even_spreads_one_full_partition(spark):
    df = spark.range(40_000).coalesce(1)
    even = kept_even(df)
    assert even.count() == 40_000
    most = even.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 10_000
    even.unpersist()


def test_a_learner_gets_few_rows_a_task_however_even_the_files(spark, monkeypatch):
    monkeypatch.setattr(search, "ROWS_PER_TASK", 5_000)
    even = kept_even(spark.range(0, 80_000, 1, spark.sparkContext.defaultParallelism))
    sizes = [r["count"] for r in even.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 80_000 and max(sizes) <= 2 * 5_000
    even.unpersist()


def test_rounds_of_the_scorer_start_from_the_mean(spark):
    rows = spark.createDataFrame([(float(i), float(i % 3)) for i in range(30)], "x double, label double")
    train = features_and_label(rows, "label", ["x"])
    model = boosted_scorer(n_estimators=1, max_depth=1, max_bin=8, colsample_bytree=0.5).fit(train)
    start, _ = model.stages[1].trees
    assert start.depth == 0 and start.predict(model.stages[0].transform(train).first()["sided_features"]) == 1.0


def test_scores_of_a_model_are_made_once_for_the_auc(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def scored(i):
        made.add(1)
        return float(i % 50)

    rows = spark.range(400).select((F.col("id") % 2).alias("label"), scored("id").alias("score"))
    assert roc_auc(rows, rows_per_task=10).first()["auc"] == pytest.approx(0.52)
    assert made.value <= 2 * 400  # a null check may call it once more
