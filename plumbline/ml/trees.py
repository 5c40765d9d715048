"""Tree ensembles under the parameter names data scientists use."""

from __future__ import annotations

import math
import warnings

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from .huber import HuberBoosting
from .scorer import BoostedScorer

MLLIB_MAX_DEPTH = 30
MLLIB_LOSSES = {"squared_error": "squared", "absolute_error": "absolute"}


def _depth(max_depth: int | None) -> int:
    if max_depth is not None and max_depth < 1:
        raise ValueError("max_depth must be at least 1")
    if max_depth is None or max_depth > MLLIB_MAX_DEPTH:
        if max_depth is not None:
            warnings.warn(f"max_depth {max_depth} is more than MLlib's {MLLIB_MAX_DEPTH}, which is used")
        return MLLIB_MAX_DEPTH
    return max_depth


def _leaf_size(min_samples_split: int) -> int:
    """MLlib bounds leaves, not splits: half the split size, an approximation."""
    if min_samples_split < 2:
        raise ValueError("min_samples_split must be at least 2")
    return math.ceil(min_samples_split / 2)


def forest_regressor(
    n_estimators: int = 100, max_depth: int | None = None, min_samples_split: int = 2, seed: int = 42, **more
) -> RandomForestRegressor:
    return RandomForestRegressor(
        numTrees=n_estimators,
        maxDepth=_depth(max_depth),
        minInstancesPerNode=_leaf_size(min_samples_split),
        featureSubsetStrategy="all",
        seed=seed,
        **more,
    )


def forest_classifier(
    n_estimators: int = 100, max_depth: int | None = None, min_samples_split: int = 2, seed: int = 42, **more
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=n_estimators,
        maxDepth=_depth(max_depth),
        minInstancesPerNode=_leaf_size(min_samples_split),
        featureSubsetStrategy="sqrt",
        seed=seed,
        **more,
    )


def boosted_regressor(
    loss: str = "squared_error", learning_rate: float = 0.1, n_estimators: int = 100,
    subsample: float = 1.0, max_depth: int = 3, seed: int = 42,
):
    """Gradient boosting with squared, absolute or Huber loss; other losses are an error."""
    if not 0 < subsample <= 1:
        raise ValueError(f"subsample {subsample} is not in (0, 1]")
    if loss == "huber":
        return HuberBoosting(
            learning_rate=learning_rate, n_estimators=n_estimators, subsample=subsample, max_depth=max_depth, seed=seed
        )
    if loss not in MLLIB_LOSSES:
        raise ValueError(f"unknown loss {loss!r}")
    return GBTRegressor(
        lossType=MLLIB_LOSSES[loss],
        stepSize=learning_rate,
        maxIter=n_estimators,
        subsamplingRate=subsample,
        maxDepth=max_depth,
        seed=seed,
    )


def boosted_scorer(
    n_estimators: int = 3000, learning_rate: float = 0.01567, max_depth: int = 10, min_child_weight: int = 6,
    max_bin: int = 3500, colsample_bytree: float = 0.48, seed: int = 41,
) -> BoostedScorer:
    """Boosted trees on a 0/1 target whose raw prediction ranks rows.

    Missing features are allowed, and ``colsample_bytree`` is the share of columns per tree.
    """
    return BoostedScorer(
        maxIter=n_estimators,
        stepSize=learning_rate,
        maxDepth=max_depth,
        minInstancesPerNode=min_child_weight,
        maxBins=max_bin,
        featureSubsetStrategy=str(colsample_bytree),
        seed=seed,
    )
