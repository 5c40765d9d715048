"""Boosted trees that learn where missing values go, and see a share of the columns per tree."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.storage import cut_lineage
from . import cells

CHECKPOINT_EVERY = 8
SIDED = "sided_features"


class MissingSides(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose missing values (NaN) stand below all values, and copies of some where they stand above.

    A split of the first form sends missing values to the left, a split of the copy to the right, so a
    tree chooses the side at every split. A feature without a copy had no missing value when
    it was fitted; a missing value that it meets later goes to the left.
    """

    low = Param(Params._dummy(), "low", "stands for a missing value of each feature", TypeConverters.toListFloat)
    high = Param(Params._dummy(), "high", "stands for a missing value in the copies", TypeConverters.toListFloat)
    sided = Param(Params._dummy(), "sided", "features that have a copy", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, low=None, high=None, sided=None):
        super().__init__()
        if low is not None:
            self._set(low=low, high=high, sided=sided)

    @classmethod
    def fitted(cls, dataset: DataFrame, features: str = "features") -> MissingSides:
        """One pass over the table; an empty table is an error."""
        first = dataset.select(features).first()
        if first is None:
            raise ValueError("no rows to fit")
        values = vector_to_array(features)
        made = []
        for i in range(len(first[0])):
            known = F.when(~F.isnan(values[i]), values[i])
            made += [F.min(known).alias(f"min_{i}"), F.max(known).alias(f"max_{i}"), F.count_if(F.isnan(values[i])).alias(f"n_{i}")]
        found = dataset.agg(*made).first()
        ends = [(found[f"min_{i}"] or 0.0, found[f"max_{i}"] or 0.0) for i in range(len(first[0]))]
        sided = [i for i in range(len(ends)) if found[f"n_{i}"]]
        gap = lambda a, b: (b - a) + 1.0 + abs(a) * 1e-6 + abs(b) * 1e-6
        return cls(
            low=[a - gap(a, b) for a, b in ends], high=[ends[i][1] + gap(*ends[i]) for i in sided], sided=sided
        )

    def owners(self) -> list[int]:
        """The feature that each place of the new vector belongs to."""
        return [*range(len(self.getOrDefault("low"))), *self.getOrDefault("sided")]

    def columns(self, features: str = "features") -> list[Column]:
        values = vector_to_array(features)
        pick = lambda i, other: F.when(F.isnan(values[i]), F.lit(other)).otherwise(values[i])
        low = [pick(i, v) for i, v in enumerate(self.getOrDefault("low"))]
        return low + [pick(i, v) for i, v in zip(self.getOrDefault("sided"), self.getOrDefault("high"))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(SIDED, array_to_vector(F.array(*self.columns())))


def masks(owners: Sequence[int], share: float, rounds: int, seed: int) -> list[list[bool]]:
    """Per round, which places a tree may use: a share of the features, one at least, each with its copy."""
    features = sorted(set(owners))
    size = max(1, int(share * len(features)))
    out = []
    for i in range(rounds):
        chosen = set(random.Random(f"{seed}-{i}").sample(features, size))
        out.append([o in chosen for o in owners])
    return out


class BoostedScorer(GBTRegressor):
    """``GBTRegressor`` on features that may be missing; a numeric ``featureSubsetStrategy`` is the share of columns per tree.

    With all columns MLlib boosts. With a share below 1 the rounds are our own: the tree of a round is fitted to what the rounds
    before left over, on a vector whose other columns are constant, so its splits
    number the features of the whole vector and all trees make one MLlib model. That
    starts from the mean, and every tree counts by the step size. Where the share leaves one feature to a tree, the rounds
    read counted cells in place of the rows, unless there are more pairs of them than the driver can hold.
    """

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        sides = MissingSides.fitted(dataset, self.getFeaturesCol())
        label = F.col(self.getLabelCol()).cast("double").alias("label")
        plain_rows = dataset.withColumnRenamed(self.getFeaturesCol(), "features").select("features", label)
        rows = sides.transform(plain_rows).select(SIDED, "label")
        strategy = self.getFeatureSubsetStrategy()
        share = float(strategy) if strategy.replace(".", "", 1).isdigit() else 1.0
        if share >= 1:
            plain = GBTRegressor(featuresCol=SIDED, labelCol="label")
            for name in ("maxIter", "stepSize", "maxDepth", "minInstancesPerNode", "maxBins", "subsamplingRate", "seed", "lossType"):
                plain.set(plain.getParam(name), self.getOrDefault(name))
            return PipelineModel(stages=[sides, plain.fit(rows)])
        chosen = masks(sides.owners(), share, self.getMaxIter(), self.getSeed())
        single = all(len({o for o, used in zip(sides.owners(), mask) if used}) == 1 for mask in chosen)
        single &= len(sides.getOrDefault("low")) <= cells.MAX_FEATURES
        model = self._boosted_on_cells(plain_rows, sides, chosen) if single else None
        return PipelineModel(stages=[sides, model or self._boosted(rows, chosen)])

    def _boosted_on_cells(self, rows: DataFrame, sides: MissingSides, chosen: list[list[bool]]) -> GBTRegressionModel | None:
        """The rounds where a tree sees one feature; None if its cells make too many pairs."""
        low, sided = sides.getOrDefault("low"), sides.getOrDefault("sided")
        unfit = F.col("label").isNull() | F.isnan("label") | (F.abs("label") == math.inf)
        found = rows.agg(F.count("*").alias("n"), F.avg("label").alias("mean"), F.count_if(unfit).alias("unfit")).first()
        if found["unfit"] or not all(map(math.isfinite, low)):
            raise ValueError("labels must be finite numbers, and features finite numbers or missing")
        bins = cells.bins_of(rows, [self.getMaxBins() - (i in sided) for i in range(len(low))])
        if not cells.can_be_held(bins, found["n"]):
            return None
        owners = sides.owners()
        copies = {i: len(low) + n for n, i in enumerate(sided)}
        rounds = cells.Rounds(cells.counted(rows, bins), bins, low, copies, found["mean"])
        trees = rounds.trees(
            [owners[mask.index(True)] for mask in chosen], self.getStepSize(), self.getMaxDepth(), self.getMinInstancesPerNode()
        )
        one = _ensemble(rows, [_mean_tree(sides.transform(rows), found["mean"])], [1.0])
        model = cells.as_model(
            cells.SummedTrees, one, rows.sparkSession, trees, len(owners), self.getStepSize(), self.getSeed(),
            maxDepth=self.getMaxDepth(), maxBins=self.getMaxBins(), minInstancesPerNode=self.getMinInstancesPerNode(),
        )
        model.summed = cells.as_model(GBTRegressionModel, one, rows.sparkSession, rounds.sums(), len(owners), 1.0, self.getSeed())
        return model

    def _boosted(self, rows: DataFrame, chosen: list[list[bool]]) -> GBTRegressionModel:
        tree = dict(maxBins=self.getMaxBins(), minInstancesPerNode=self.getMinInstancesPerNode())
        mean = rows.agg(F.avg("label")).first()[0]
        start = _mean_tree(rows, mean)
        values = vector_to_array(SIDED)

        def ready(state: DataFrame, i: int) -> DataFrame:
            """With what the tree of a round is fitted to, as a learner reads that several times."""
            masked = array_to_vector(F.array(*[values[j] if used else F.lit(0.0) for j, used in enumerate(chosen[i])]))
            return state.select("*", masked.alias("masked"), (F.col("label") - F.col("f")).alias("rest"))

        trees, kept = [start], None
        for i in range(len(chosen)):
            if kept is None:
                kept = ready(rows.select(SIDED, "label", F.lit(mean).cast("double").alias("f")), 0).persist()
            else:
                step = (F.col("f") + F.lit(self.getStepSize()) * F.col("prediction")).alias("f")
                state = ready(trees[-1].transform(kept.select(SIDED, "label", "f")).select(SIDED, "label", step), i)
                if i % CHECKPOINT_EVERY == 0:
                    state = cut_lineage(state)
                else:
                    state = state.persist()
                    state.count()
                kept.unpersist()
                kept = state
            learner = DecisionTreeRegressor(
                featuresCol="masked", labelCol="rest", maxDepth=self.getMaxDepth(), seed=self.getSeed() + i, **tree
            )
            trees.append(learner.fit(kept.select("masked", "rest")).setFeaturesCol(SIDED))
        if kept is not None:
            kept.unpersist()
        return _ensemble(rows, trees, [1.0] + [self.getStepSize()] * len(chosen))


def _mean_tree(rows: DataFrame, mean: float) -> DecisionTreeRegressionModel:
    """A tree without a split is the mean, and one row is enough to make it."""
    one = rows.limit(1).select(SIDED, F.lit(mean).cast("double").alias("label"))
    return DecisionTreeRegressor(featuresCol=SIDED, labelCol="label", maxDepth=0).fit(one)


def _ensemble(rows: DataFrame, trees: Sequence, weights: Sequence[float]) -> GBTRegressionModel:
    """One MLlib model of the trees."""
    context = rows.sparkSession.sparkContext
    package = context._jvm.org.apache.spark.ml.regression
    made = context._gateway.new_array(package.DecisionTreeRegressionModel, len(trees))
    factors = context._gateway.new_array(context._gateway.jvm.double, len(trees))
    for i, (model, weight) in enumerate(zip(trees, weights)):
        made[i], factors[i] = model._java_obj, float(weight)
    model = GBTRegressionModel(package.GBTRegressionModel(f"boosted_{trees[-1].uid}", made, factors))
    return model.setFeaturesCol(SIDED)
