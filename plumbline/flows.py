"""The analyses end to end, each over tables given by the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from .functions.encode import map_values, replace_values
from .ml.logistic import PenalisedLogit, weights
from .ml.search import SearchResult, better_of, fit, grid_search, importances, parameter_grid, weight_rows, with_score
from .ml.trees import boosted_regressor, boosted_scorer, forest_classifier, forest_regressor
from .operators.features import features_and_label, insurance_features, standardize
from .operators.metrics import auc_trapezoid, classification_metrics, regression_metrics, roc_auc, roc_curve
from .operators.quality import drop_duplicates, drop_null_rows, midrange_impute
from .operators.select import all_but_last, attach_predictions, by_position, drop_columns
from .operators.split import add_folds, add_stratified_folds, train_test_split
from .sources.files import csv_roundtrip
from .sources.tables import save_model

# The searched parameters.
BOOSTING_GRID = {"loss": ["huber", "ls"], "learning_rate": [0.1, 0.3], "subsample": [1.0, 3.0]}
FOREST_REGRESSION_GRID = {"min_samples_split": [2, 4], "n_estimators": [10, 20], "max_depth": [100, 200]}
LOGIT_GRID = {"intercept_scaling": [1, 3], "max_iter": [100, 200]}
LOGIT_STRENGTHS = [0.1, 1, 10]
FOREST_CLASSIFICATION_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [None, 10, 20, 30],
    "min_samples_split": [2, 5, 10],
}
# Encodings and columns of the insurance and credit tables.
GENDER = {"Female": 1, "Male": 0}
DAMAGE = {"Yes": 1, "No": 0}
VEHICLE_AGE = {"1-2 Year": 1, "< 1 Year": 0, "> 2 Years": 2}
CREDIT_GENDER = {"f": 0, "m": 1}
UNUSED_INSURANCE = ["Driving_License", "Region_Code", "Policy_Sales_Channel", "Gender", "Vintage"]


@dataclass
class OrderVolume:
    boosted: SearchResult
    forest: SearchResult
    scores: DataFrame  # model, mae, mse, r2
    importances: DataFrame  # model, feature, importance
    predictions: DataFrame  # label, boosted, forest


def order_volume(
    orders: DataFrame, impute: str, boosting: Mapping[str, Sequence] = BOOSTING_GRID,
    forest: Mapping[str, Sequence] = FOREST_REGRESSION_GRID, folds: int = 5, seed: int = 42, **boosting_fixed: Any,
) -> OrderVolume:
    """Regression of the last column on the others: clean, impute, split, search, score.

    Duplicate rows are removed first, so the whole row is the split key.
    """
    clean = midrange_impute(drop_duplicates(orders), impute)
    names, target = all_but_last(clean).columns, by_position(clean, -1).columns[0]
    keyed = clean.withColumn("row_key", F.md5(F.to_json(F.struct("*"))))
    train, test = train_test_split(keyed, "row_key", 0.2, seed)
    shape = lambda df: features_and_label(df, target, names, keep=["row_key"])
    fit_on, check_on = add_folds(shape(train), "row_key", folds, seed), shape(test)
    boosted = grid_search(
        lambda **p: boosted_regressor(**boosting_fixed, **p), parameter_grid(boosting), fit_on, "r2", folds
    )
    trees = grid_search(forest_regressor, parameter_grid(forest), fit_on, "r2", folds)
    spark = orders.sparkSession
    scored = {"boosted": boosted.best_model, "forest": trees.best_model}
    one = lambda f: [f(name, model).select(F.lit(name).alias("model"), "*") for name, model in scored.items()]
    scores = one(lambda _, m: regression_metrics(m.transform(check_on)))
    shares = one(lambda _, m: importances(m, names, spark))
    both = check_on
    for name, model in scored.items():
        both = model.transform(both).withColumnRenamed("prediction", name).select(*both.columns, name)
    return OrderVolume(
        boosted, trees, scores[0].unionByName(scores[1]), shares[0].unionByName(shares[1]),
        both.select("row_key", "label", "boosted", "forest"),
    )


@dataclass
class Credit:
    l1: SearchResult
    l2: SearchResult
    weights: DataFrame  # model, term, weight
    scores: DataFrame  # model, accuracy, recall
    better: str


def credit(
    table: DataFrame, target: str = "kredit", gender: str = "gender", scale: str = "hoehe",
    grid: Mapping[str, Sequence] = LOGIT_GRID, folds: int = 5, seed: int = 42, save_to: str | None = None,
) -> Credit:
    """L1 against L2 logistic regression; the more accurate model is saved, L2 on a tie."""
    clean = replace_values(table, gender, CREDIT_GENDER, strict=True)
    clean = drop_duplicates(drop_null_rows(clean))
    clean = standardize(clean, [scale])
    names = [c for c in clean.columns if c != target]
    keyed = clean.withColumn("row_key", F.md5(F.to_json(F.struct("*"))))
    train, test = train_test_split(keyed, "row_key", 0.2, seed)
    shape = lambda df: features_and_label(df, target, names, keep=["row_key"])
    fit_on, check_on = add_stratified_folds(shape(train), "row_key", "label", folds), shape(test)
    candidates = parameter_grid(grid)
    l1 = grid_search(
        lambda **p: PenalisedLogit(penalty="l1", solver="liblinear", **p), candidates, fit_on, "accuracy", folds
    )
    l2 = grid_search(lambda **p: PenalisedLogit(penalty="l2", **p), candidates, fit_on, "accuracy", folds)
    spark = table.sparkSession
    found, terms, scores = [], None, None
    for name, search in (("l1", l1), ("l2", l2)):
        label = F.lit(name).alias("model")
        score = classification_metrics(search.best_model.transform(check_on)).select(label, "*")
        term = weight_rows(spark, names, *weights(search.best_model)).select(label, "*")
        found.append((name, search.best_model, score.first()["accuracy"]))
        scores = score if scores is None else scores.unionByName(score)
        terms = term if terms is None else terms.unionByName(term)
    better = better_of(*found)
    if save_to:
        save_model(better[1], save_to)
    return Credit(l1, l2, terms, scores, better[0])


def encode_insurance(table: DataFrame) -> DataFrame:
    out = map_values(table, "Gender", GENDER)
    out = map_values(out, "Vehicle_Damage", DAMAGE)
    return map_values(out, "Vehicle_Age", VEHICLE_AGE)


@dataclass
class Insurance:
    logits: list[SearchResult]
    logit_scores: DataFrame  # idx, C, auc
    best_curve: DataFrame  # the ROC curve of the best logit
    forest: SearchResult
    forest_curve: DataFrame
    forest_auc: DataFrame


def insurance(
    table: DataFrame, key: str = "id", target: str = "Response", strengths: Sequence[float] = LOGIT_STRENGTHS,
    forest: Mapping[str, Sequence] = FOREST_CLASSIFICATION_GRID, folds: int = 5, seed: int = 42,
) -> Insurance:
    """Cross-sell classification: three logistic strengths, then a forest, by ROC AUC."""
    rows = drop_columns(encode_insurance(table), UNUSED_INSURANCE)
    names = [c for c in rows.columns if c not in (key, target)]
    train, test = train_test_split(rows, key, 0.2, seed)
    fit_on = add_stratified_folds(features_and_label(train, target, names, keep=[key]), key, "label", folds)
    check_on = features_and_label(test, target, names, keep=[key])
    logits, curves, aucs = [], [], []
    for c in strengths:
        search = grid_search(
            lambda **p: PenalisedLogit(penalty="l2", solver="liblinear", **p), [{"C": float(c)}], fit_on, "roc_auc", folds
        )
        curve = roc_curve(with_score(search.best_model.transform(check_on)))
        logits.append(search)
        curves.append(curve)
        aucs.append(auc_trapezoid(curve).first()["auc"])
    best = max(range(len(aucs)), key=lambda i: (aucs[i] if aucs[i] is not None else -1.0, -i))
    spark = table.sparkSession
    scores = spark.createDataFrame(
        [(i, float(c), a) for i, (c, a) in enumerate(zip(strengths, aucs))], "idx int, C double, auc double"
    )
    trees = grid_search(forest_classifier, parameter_grid(forest), fit_on, "roc_auc", folds)
    curve = roc_curve(with_score(trees.best_model.transform(check_on)))
    return Insurance(logits, scores, curves[best], trees, curve, auc_trapezoid(curve))


@dataclass
class Submission:
    sheet: DataFrame
    held_out_auc: DataFrame
    held_out_curve: DataFrame


def submission(
    train: DataFrame, test: DataFrame, sheet: DataFrame, path: str, key: str = "id", target: str = "Response",
    seed: int = 41, **boosting: Any,
) -> Submission:
    """Features, boosted scores for the test table, and the sheet written and read back.

    Features may be missing in either table; the trees learn on which side they belong.
    """
    rows, unseen = insurance_features(train), insurance_features(test)
    names = [c for c in rows.columns if c not in (key, target)]
    learn, check = train_test_split(rows, key, 0.2, seed)
    shape = lambda df: features_and_label(df, target, names, keep=[key], missing="keep")
    model = fit(boosted_scorer(seed=seed, **boosting), shape(learn))
    unseen = unseen.withColumn(target, F.lit(0.0))
    scored = model.transform(shape(unseen))
    filled = attach_predictions(sheet, scored, key, target)
    held_out = with_score(model.transform(shape(check)))
    return Submission(csv_roundtrip(filled, path), roc_auc(held_out), roc_curve(held_out))
