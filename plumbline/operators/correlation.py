"""Pearson correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col, numbers


def pearson(a: str, b: str) -> Column:
    """Correlation over the rows that have both values; NULL if one is constant.

    The built-in ``corr`` raises on a constant column in ANSI mode, and the
    computed deviation of one need not be exactly zero.
    """
    x = F.when(col(b).isNotNull(), col(a).cast("double"))
    y = F.when(col(a).isNotNull(), col(b).cast("double"))
    varied = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varied, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pairwise") -> DataFrame:
    """``(col_x, col_y, corr)`` for every ordered pair, in one pass.

    ``pairwise`` skips a row only for the pairs it lacks a value of.
    ``matrix`` is for wide tables without missing values and varying columns:
    one Gramian matrix instead of one aggregate per pair.
    """
    columns = numbers(df, columns)
    if method == "matrix":
        vectors = VectorAssembler(inputCols=columns, outputCol="__v").transform(df.select(*map(col, columns)))
        matrix = Correlation.corr(vectors, "__v").first()[0].toArray()
        rows = [(a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
        return df.sparkSession.createDataFrame(rows, "col_x string, col_y string, corr double")
    pairs = {(a, b): pearson(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]}
    pairs |= {(c, c): F.when(F.min(col(c)) < F.max(col(c)), F.lit(1.0)) for c in columns}
    cells = [
        F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), corr.alias("corr"))
        for (a, b), corr in pairs.items()
    ]
    half = df.agg(F.array(*cells).alias("c")).select(F.inline("c"))
    both = F.when(F.col("col_x") == F.col("col_y"), F.array(F.struct("col_x", "col_y"))).otherwise(
        F.array(F.struct("col_x", "col_y"), F.struct(F.col("col_y").alias("col_x"), F.col("col_x").alias("col_y")))
    )
    return half.select(F.explode(both).alias("p"), "corr").select("p.col_x", "p.col_y", "corr")


def heatmap_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The matrix with the two-decimal text of a heat map."""
    return correlation_matrix(df, columns).withColumn("label", F.round("corr", 2))


def target_correlation(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, corr)`` with the target, highest first, the target itself left out."""
    columns = [c for c in numbers(df, columns) if c != target]
    cells = [F.struct(F.lit(c).alias("column"), pearson(c, target).alias("corr")) for c in columns]
    found = df.agg(F.array(*cells).alias("c")).select(F.inline("c"))
    return found.orderBy(F.col("corr").desc_nulls_last(), "column")
