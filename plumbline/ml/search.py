"""Grid search over candidates, with folds from a key."""

from __future__ import annotations

import itertools
import json
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col
from ..operators.metrics import classification_metrics, regression_metrics, roc_auc
from .scorer import MissingSides


def parameter_grid(values: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """All combinations; names in alphabetic order, the last name changes fastest."""
    names = sorted(values)
    return [dict(zip(names, combo)) for combo in itertools.product(*(values[n] for n in names))]


def with_score(df: DataFrame) -> DataFrame:
    """Adds ``score``: the probability of class 1, or the prediction itself."""
    if "probability" in df.columns:
        return df.withColumn("score", vector_to_array("probability")[1])
    return df.withColumn("score", col("prediction").cast("double"))


# Each reads only (label, prediction or score) and returns one number.
SCORES: dict[str, Callable[[DataFrame], float | None]] = {
    "r2": lambda df: regression_metrics(df).first()["r2"],
    "accuracy": lambda df: classification_metrics(df).first()["accuracy"],
    "roc_auc": lambda df: roc_auc(with_score(df)).first()["auc"],
}


SPREAD_FROM = 10_000  # rows; fewer are not worth a shuffle
ROWS_PER_TASK = 500_000  # a learner's own form of a row takes several times the bytes of the file


def kept_even(train: DataFrame) -> DataFrame:
    """The table persisted in partitions of similar size, of about ``ROWS_PER_TASK`` rows at most.

    A learner passes over the rows many times and every pass waits for the
    largest partition. One job counts the rows of each; only where one
    partition holds more than twice an even share, or twice the rows of a task, are the rows dealt out again,
    once. Files are cut by their compressed bytes, which say little about what a task has to
    hold, so rows are dealt out from their input and not from a cached form. A lost block is rebuilt from its input.
    """
    sizes = train.groupBy(F.spark_partition_id().alias("p")).count()
    found = sizes.agg(F.count("*").alias("used"), F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    rows = found["rows"] or 0
    lanes = max(train.sparkSession.sparkContext.defaultParallelism, found["used"], math.ceil(rows / ROWS_PER_TASK))
    if rows >= SPREAD_FROM and found["most"] > 2 * rows / lanes:
        train = train.repartition(lanes)
    return train.persist()


def fit(estimator, train: DataFrame) -> Model:
    """Fit on a persisted, evenly spread table."""
    train = kept_even(train)
    try:
        return estimator.fit(train)
    finally:
        train.unpersist()


def _first_line(error: Exception) -> str:
    """What went wrong, without the trace of the other side."""
    return f"{type(error).__name__}: {(str(error).strip() or 'no message').splitlines()[0]}"


@dataclass
class SearchResult:
    best_model: Model
    best_params: dict
    best_score: float
    table: DataFrame  # candidate, params, mean_score, rank, error


def grid_search(
    make: Callable[..., Any],
    grid: Sequence[Mapping[str, Any]],
    train: DataFrame,
    scoring: str,
    folds: int = 5,
    fold: str = "fold",
    parallelism: int = 4,
) -> SearchResult:
    """Cross-validates every candidate and refits the best one on all rows.

    ``train`` has ``features``, ``label`` and a fold column. A candidate that cannot be
    made, fitted or scored is listed last with its error and no score; what still runs
    of it is ended by the tag of its jobs, and the other candidates go on. If no candidate gets
    through, the search raises ValueError. Equal means: the earlier candidate.
    The loop is our own because MLlib's cross-validation checks a fold column
    with a Python function per row and fails as a whole on one bad candidate.
    """
    score = SCORES[scoring]
    grid = [dict(g) for g in grid]
    errors: dict[int, str] = {}
    means: dict[int, float | None] = {}
    train = kept_even(train)
    context, search = train.sparkSession.sparkContext, uuid.uuid4().hex

    def tried(i: int, work: Callable[[], Any]) -> Any:
        tag = f"search-{search}-{i}"
        context.addJobTag(tag)
        try:
            return work()
        except Exception as error:
            errors[i] = _first_line(error)
            context.cancelJobsWithTag(tag)
        finally:
            context.removeJobTag(tag)

    def score_of(i: int) -> float | None:
        values = []
        for f in range(folds):
            fitted = make(**grid[i]).fit(train.where(col(fold) != f))
            values.append(score(fitted.transform(train.where(col(fold) == f))))
        return sum(values) / len(values) if all(v is not None for v in values) else None

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            for i, value in enumerate(pool.map(lambda i: tried(i, lambda: score_of(i)), range(len(grid)))):
                means[i] = value
        order = sorted((i for i in means if i not in errors), key=lambda i: (means[i] is None, -(means[i] or 0.0), i))
        model = None
        for best in order:
            model = tried(best, lambda: make(**grid[best]).fit(train))
            if model is not None:
                break
        if model is None:
            raise ValueError(f"no candidate can be fitted: {errors}")
    finally:
        train.unpersist()
    means = {i: None if i in errors else mean for i, mean in means.items()}
    order = [i for i in order if i not in errors]
    ranks = {i: n + 1 for n, i in enumerate([*order, *sorted(errors)])}
    rows = [
        (i, json.dumps(params), means.get(i), ranks[i], errors.get(i)) for i, params in enumerate(grid)
    ]
    table = train.sparkSession.createDataFrame(
        rows, "candidate int, params string, mean_score double, rank int, error string"
    )
    return SearchResult(model, grid[best], means[best], table)


def better_of(first: tuple[str, Any, float], second: tuple[str, Any, float]) -> tuple[str, Any, float]:
    """The first of two scored models only if it is strictly better."""
    return first if first[2] > second[2] else second


def importances(model: Model, names: Sequence[str], spark) -> DataFrame:
    """``(feature, importance)``; they sum to 1.

    For a sequence of single trees it is the mean of the trees' importances; a feature
    with a copy for missing values gets the importance of both.
    """
    stages = getattr(model, "stages", [model])
    owners = next((s.owners() for s in stages if isinstance(s, MissingSides)), range(len(names)))
    trees = [s for s in stages if hasattr(s, "featureImportances")]
    total = [0.0] * len(names)
    for t in trees:
        for i, v in enumerate(t.featureImportances.toArray()):
            total[owners[i]] += float(v)
    whole = sum(total) or 1.0
    rows = [(n, v / whole) for n, v in zip(names, total)]
    return spark.createDataFrame(rows, "feature string, importance double")


def weight_rows(spark, names: Sequence[str], coefficients: Sequence[float], intercept: float) -> DataFrame:
    """``(term, weight)`` of a linear model."""
    rows = [*zip(names, map(float, coefficients)), ("(intercept)", float(intercept))]
    return spark.createDataFrame(rows, "term string, weight double")

