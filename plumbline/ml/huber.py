"""Gradient boosting with Huber loss, which MLlib lacks."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, functions as F

from ..functions.encode import mapped
from ..plans.order_stats import quantiles
from ..plans.storage import cut_lineage

CHECKPOINT_EVERY = 8


class HuberBoosting(Estimator):
    """Each round fits an MLlib tree to clipped residuals.

    Residuals are clipped at their ``alpha`` quantile. The value of a leaf is
    the median of its residuals plus the mean of what remains, clipped. A tree
    has at most ``2 ** max_depth`` leaves, which is all that reaches the driver
    per round. The fitted model is a plain ``PipelineModel``: the trees, and
    one SQL stage that adds up their leaf values.
    """

    learning_rate = Param(Params._dummy(), "learning_rate", "step", TypeConverters.toFloat)
    n_estimators = Param(Params._dummy(), "n_estimators", "trees", TypeConverters.toInt)
    subsample = Param(Params._dummy(), "subsample", "share of rows per tree", TypeConverters.toFloat)
    max_depth = Param(Params._dummy(), "max_depth", "depth", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "quantile of the clipping", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, learning_rate=0.1, n_estimators=100, subsample=1.0, max_depth=3, alpha=0.9, seed=42):
        super().__init__()
        self._set(**{
            "learning_rate": learning_rate, "n_estimators": n_estimators, "subsample": subsample,
            "max_depth": max_depth, "alpha": alpha, "seed": seed,
        })

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        get = self.getOrDefault
        rate, seed, share = get("learning_rate"), get("seed"), get("subsample")
        kept = dataset.select("features", F.col("label").cast("double").alias("label")).persist()
        rows = kept.count()
        start = quantiles(kept, "label", [0.5], rows=rows).first()["quantiles"][0]
        state = kept.withColumn("__f", F.lit(float(start)))
        trees, leaf_values = [], []
        for i in range(get("n_estimators")):
            leaf = f"leaf_{i}"
            missed = state.withColumn("__r", F.col("label") - F.col("__f"))
            chosen = self._part(missed, share, seed + i)
            far = quantiles(chosen.select(F.abs("__r").alias("v")), "v", [get("alpha")], rows=rows)
            delta = float(far.first()["quantiles"][0])
            clip = lambda c: F.greatest(F.lit(-delta), F.least(F.lit(delta), c))
            tree = DecisionTreeRegressor(
                labelCol="__g", maxDepth=get("max_depth"), seed=seed + i, leafCol=leaf, predictionCol=f"tree_{i}"
            ).fit(chosen.withColumn("__g", clip(F.col("__r"))))
            # the one table kept for the next round: rows with their leaf
            placed = tree.transform(missed).drop(f"tree_{i}")
            placed = cut_lineage(placed) if (i + 1) % CHECKPOINT_EVERY == 0 else placed.persist()
            chosen = self._part(placed, share, seed + i)
            halves = quantiles(chosen, "__r", [0.5], by=[leaf], rows=rows)
            middle = {r[leaf]: r["quantiles"][0] for r in halves.collect()}
            rest = F.col("__r") - mapped(F.col(leaf), middle)
            means = chosen.groupBy(leaf).agg(F.avg(clip(rest)).alias("m")).collect()
            values = {r[leaf]: middle[r[leaf]] + r["m"] for r in means}
            trees.append(tree)
            leaf_values.append(values)
            step = F.coalesce(mapped(F.col(leaf), values), F.lit(0.0))
            state = placed.select("features", "label", (F.col("__f") + rate * step).alias("__f"))
            kept.unpersist()
            kept = placed
        kept.unpersist()
        return PipelineModel(stages=[*trees, _sum_of_leaves(start, rate, leaf_values)])

    @staticmethod
    def _part(rows: DataFrame, share: float, seed: int) -> DataFrame:
        if share >= 1:
            return rows
        draw = F.pmod(F.xxhash64("label", "__f", F.lit(seed)), F.lit(1 << 30))
        return rows.where(draw < int(share * (1 << 30)))


def _sum_of_leaves(start: float, rate: float, leaf_values: list[dict]) -> SQLTransformer:
    parts = [repr(float(start)) + "D"]
    for i, values in enumerate(leaf_values):
        cases = " ".join(f"WHEN {leaf!r}D THEN {float(v)!r}D" for leaf, v in sorted(values.items()))
        parts.append(f"{float(rate)!r}D * (CASE leaf_{i} {cases} ELSE 0D END)")
    drop = ", ".join(f"leaf_{i}, tree_{i}" for i in range(len(leaf_values)))
    keep = f"* EXCEPT ({drop})" if drop else "*"
    return SQLTransformer(statement=f"SELECT {keep}, {' + '.join(parts)} AS prediction FROM __THIS__")
