"""KMeans, its centres and its cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import col, numbers
from ..plans.stats import one_row


def cluster_vectors(df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``features`` from numeric columns, or from one array column."""
    if columns is not None and len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, T.ArrayType):
        return df.select(*map(col, keep), array_to_vector(col(columns[0]).cast("array<double>")).alias("features"))
    columns = numbers(df, columns)
    table = df.select(
        *map(col, keep), *[col(c).cast("double").alias(f"__f{i}") for i, c in enumerate(columns)]
    )
    made = VectorAssembler(
        inputCols=[f"__f{i}" for i in range(len(columns))], outputCol="features", handleInvalid="error"
    ).transform(table)
    return made.select(*map(col, keep), "features")


def fit_kmeans(vectors: DataFrame, k: int = 6, seed: int = 42, max_iter: int = 300) -> KMeansModel:
    return KMeans(k=k, initMode="k-means||", seed=seed, maxIter=max_iter, tol=1e-4).fit(vectors)


def model_centers(model: KMeansModel, spark) -> DataFrame:
    """``(cluster, dim, value)`` of a fitted model; ``k`` times the dimension rows."""
    rows = [(c, d, float(v)) for c, vec in enumerate(model.clusterCenters()) for d, v in enumerate(vec)]
    return spark.createDataFrame(rows, "cluster int, dim int, value double")


def assigned_centers(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """``(cluster, dim, value)``: the mean of the rows assigned to each cluster."""
    parts = df.select(col(cluster).alias("cluster"), F.posexplode(col(vector)).alias("dim", "__v"))
    return parts.groupBy("cluster", "dim").agg(F.avg(F.col("__v").cast("double")).alias("value"))


def inertia(df: DataFrame, vector: str, centers: DataFrame) -> DataFrame:
    """``(inertia)``: sum of squared distances to the nearest centre.

    The ``k`` centres reach the rows as one array; rows are not multiplied.
    """
    one = centers.groupBy("cluster").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"]).alias("c")
    )
    every = one_row(one.agg(F.collect_list("c").alias("cs"))).getField("cs")
    rows = df.select(col(vector).cast("array<double>").alias("__v"), every.alias("__every"))
    distance = lambda c: F.aggregate(
        F.zip_with("__v", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
    )
    return rows.agg(F.sum(F.array_min(F.transform("__every", distance))).alias("inertia"))
