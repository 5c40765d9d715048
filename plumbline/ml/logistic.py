"""Logistic regression with the penalty scale ``C``."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, functions as F


class PenalisedLogit(Estimator):
    """Minimises ``penalty(w) + C * sum(log loss)`` over ``features`` and ``label``.

    ``solver="lbfgs"`` leaves the intercept free of the penalty.
    ``solver="liblinear"`` penalises it: the intercept is the weight of a
    constant column ``intercept_scaling`` times that constant. MLlib ignores a
    column that does not vary, so for half of the rows features, constant and
    label are negated together. That leaves every log loss as it is.
    """

    penalty = Param(Params._dummy(), "penalty", "l1 or l2", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "weight of the loss", TypeConverters.toFloat)
    solver = Param(Params._dummy(), "solver", "lbfgs or liblinear", TypeConverters.toString)
    intercept_scaling = Param(Params._dummy(), "intercept_scaling", "constant column", TypeConverters.toFloat)
    max_iter = Param(Params._dummy(), "max_iter", "iterations", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, penalty="l2", C=1.0, solver="lbfgs", intercept_scaling=1.0, max_iter=100):
        super().__init__()
        self._setDefault(penalty="l2", C=1.0, solver="lbfgs", intercept_scaling=1.0, max_iter=100)
        self._set(**self._input_kwargs)
        if penalty not in ("l1", "l2"):
            raise ValueError(f"penalty {penalty!r} is not l1 or l2")
        if solver not in ("lbfgs", "liblinear"):
            raise ValueError(f"solver {solver!r} is not lbfgs or liblinear")
        if solver == "lbfgs" and penalty == "l1":
            raise ValueError("solver lbfgs has no l1 penalty")
        if C <= 0 or intercept_scaling <= 0 or max_iter < 1:
            raise ValueError("C, intercept_scaling and max_iter must be positive")

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        get = self.getOrDefault
        rows = dataset.count()
        learner = LogisticRegression(
            elasticNetParam=1.0 if get("penalty") == "l1" else 0.0,
            regParam=1.0 / (get("C") * rows),
            standardization=False,
            maxIter=get("max_iter"),
            tol=1e-9,
        )
        if get("solver") == "lbfgs":
            return Pipeline(stages=[learner]).fit(dataset)
        constant = SQLTransformer(
            statement=f"SELECT *, CAST({get('intercept_scaling')} AS DOUBLE) AS bias_column FROM __THIS__"
        )
        joined = VectorAssembler(inputCols=["features", "bias_column"], outputCol="biased_features")
        flat = F.transform(vector_to_array("biased_features"), lambda v: v * F.col("__sign"))
        sign = F.when(F.pmod(F.xxhash64(vector_to_array("features"), "label"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
        mirrored = (
            joined.transform(constant.transform(dataset))
            .withColumn("__sign", sign)
            .select(
                array_to_vector(flat).alias("biased_features"),
                F.when(F.col("__sign") > 0, F.col("label")).otherwise(1 - F.col("label")).alias("label"),
            )
        )
        learner.setFitIntercept(False).setFeaturesCol("biased_features")
        return PipelineModel(stages=[constant, joined, learner.fit(mirrored)])


def weights(model: PipelineModel) -> tuple[list[float], float]:
    """Coefficients and intercept of a fitted :class:`PenalisedLogit`."""
    fitted: LogisticRegressionModel = model.stages[-1]
    w = [float(v) for v in fitted.coefficients]
    if len(model.stages) == 1:
        return w, float(fitted.intercept)
    statement = model.stages[0].getStatement()
    scale = float(statement.split("CAST(")[1].split(" AS")[0])
    return w[:-1], scale * w[-1]
