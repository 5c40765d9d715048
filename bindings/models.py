"""Models; those that SQL cannot repeat are checked against numpy in the tests."""

from pyspark.sql import functions as F

from plumbline import flows
from plumbline.functions.columns import numeric_columns
from plumbline.ml import clusters
from plumbline.ml.logistic import PenalisedLogit, weights
from plumbline.ml.search import fit, grid_search, importances, parameter_grid, weight_rows, with_score
from plumbline.ml.trees import boosted_regressor, boosted_scorer, forest_classifier, forest_regressor
from plumbline.operators import metrics, split
from plumbline.operators.features import features_and_label, standardize
from plumbline.plans.storage import fresh_path

from .registry import holey, query, rounded

_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_PRICE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice"]
_FLAG = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _prices(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "net_price", F.col("l_extendedprice") * (1 - F.col("l_discount"))
    )
    parts = split.train_test_split(rows, _KEY, 0.2, 42)
    return [features_and_label(p, "net_price", _PRICE, keep=_KEY) for p in parts]


def _flags(t):
    rows = t.lineitem.withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    rows = standardize(rows.select(*_KEY, *_FLAG, "returned"), _FLAG)
    parts = split.train_test_split(rows, _KEY, 0.2, 42)
    return [features_and_label(p, "returned", _FLAG, keep=_KEY) for p in parts]


def _errors(model, test):
    return metrics.regression_metrics(model.transform(test))


@query("gbt_regression")
def _(t):
    train, test = _prices(t)
    return _errors(fit(boosted_regressor(learning_rate=0.3), train), test)


@query("huber_regression")
def _(t):
    train, test = _prices(t)
    return _errors(fit(boosted_regressor(loss="huber", n_estimators=3, learning_rate=0.3), train), test)


@query("rf_regression")
def _(t):
    train, test = _prices(t)
    return _errors(fit(forest_regressor(n_estimators=10, max_depth=8, min_samples_split=4), train), test)


@query("feature_importance")
def _(t):
    train, _ = _prices(t)
    return importances(fit(forest_regressor(n_estimators=10, max_depth=6), train), _PRICE, t.spark)


@query("logistic_l1")
def _(t):
    train, _ = _flags(t)
    model = fit(PenalisedLogit(penalty="l1", solver="liblinear", C=0.01), train)
    return weight_rows(t.spark, _FLAG, *weights(model))


@query("logistic_l2")
def _(t):
    train, _ = _flags(t)
    return weight_rows(t.spark, _FLAG, *weights(fit(PenalisedLogit(), train)))


@query("predict_proba")
def _(t):
    train, test = _flags(t)
    return with_score(fit(PenalisedLogit(), train).transform(test)).select(*_KEY, "label", "prediction", "score")


@query("rf_classification")
def _(t):
    train, test = _flags(t)
    model = fit(forest_classifier(n_estimators=10, max_depth=8, min_samples_split=5), train)
    return metrics.roc_auc(with_score(model.transform(test)))


@query("gbt_scoring")
def _(t):
    train, test = _flags(t)
    model = fit(boosted_scorer(), train)
    return metrics.roc_auc(with_score(model.transform(test)))


_MISSING_SIDE = """
WITH r AS (SELECT nullif(l_discount, 0.0) AS v, l_quantity AS y FROM lineitem),
g AS (SELECT v, count(*) AS n, sum(y) AS s FROM r GROUP BY v),
cuts AS (  -- values up to the cut go to the left, missing ones to either side
  SELECT c.v AS cut, m.missing_left, sum(g.n) FILTER (left_side) AS nl, sum(g.s) FILTER (left_side) AS sl,
         sum(g.n) FILTER (NOT left_side) AS nr, sum(g.s) FILTER (NOT left_side) AS sr
  FROM g c, (VALUES (true), (false)) m(missing_left), g, LATERAL (SELECT coalesce(g.v <= c.v, m.missing_left) AS left_side)
  WHERE c.v IS NOT NULL GROUP BY ALL),
best AS (SELECT * FROM cuts WHERE nl >= 6 AND nr >= 6 ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)
SELECT g.v AS l_discount, round(CASE WHEN coalesce(g.v <= cut, missing_left) THEN sl / nl ELSE sr / nr END, 4) AS predicted
FROM g, best"""


@query("gbt_missing_side", _MISSING_SIDE)
def _(t):
    train = features_and_label(holey(t), "l_quantity", ["l_discount"], keep=["l_discount"], missing="keep")
    model = fit(boosted_scorer(n_estimators=1, max_depth=1, max_bin=32, colsample_bytree=1.0), train)
    predicted = model.transform(train).groupBy("l_discount").agg(F.min("prediction").alias("predicted"))
    return rounded(predicted)


@query("grid_search_cv")
def _(t):
    train, _ = _flags(t)
    folded = split.add_folds(train, _KEY, 3, 42)
    grid = parameter_grid({"C": [0.1, 10.0], "max_iter": [20], "penalty": ["l2", "l3"]})
    return grid_search(PenalisedLogit, grid, folded, "roc_auc", folds=3).table


@query("kmeans_fit")
def _(t):
    vectors = clusters.cluster_vectors(t.embeddings, ["embedding"])
    return clusters.model_centers(clusters.fit_kmeans(vectors, k=6), t.spark)


@query("kmeans_columns")
def _(t):
    vectors = clusters.cluster_vectors(t.part, numeric_columns(t.part))
    model = clusters.fit_kmeans(vectors, k=6)
    return t.spark.createDataFrame([(6, float(model.summary.trainingCost))], "k int, inertia double")


def _policies(t):
    return t.events.select(
        F.col("event_id").alias("id"),
        (F.col("user_id") % 60).alias("Age"),
        (F.col("user_id") % 3).alias("Vehicle_Age"),
        (F.col("user_id") % 2).alias("Previously_Insured"),
        (F.col("event_type") == "click").cast("int").alias("Vehicle_Damage"),
        F.col("value").alias("Annual_Premium"),
        (F.col("event_type") == "purchase").cast("int").alias("Response"),
    )


@query("submission")
def _(t):
    rows = split.mark_split(_policies(t), "id", 0.3, 7, "unseen")
    train = rows.where("NOT unseen").drop("unseen")
    test = rows.where("unseen").drop("unseen", "Response")
    sheet = test.select("id", F.lit(0.0).alias("Response"))
    done = flows.submission(
        train, test, sheet, fresh_path(t.spark, "submission"), n_estimators=5, max_depth=4, max_bin=64
    )
    return done.sheet
