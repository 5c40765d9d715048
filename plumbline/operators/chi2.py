"""Choice of the features that depend most on a class, by the chi-square statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import col, numbers, require
from ..plans.stats import drop_null_keys, long_stats


def chi2_scores(df: DataFrame, label: str, features: Sequence[str] | None = None) -> DataFrame:
    """``(feature, chi2, rank)`` of features that count something, so are not negative.

    The mass of a feature in each class is compared with the class's share of the rows. All
    features and classes come from one hash aggregate over the table; what follows has a row per
    class and feature. Rows without a class are left out, a missing feature counts nothing, a feature with a
    negative value or without mass has no score and comes last. Equal scores: by name.
    """
    require(df, label)
    features = numbers(df, features, exclude=[label])
    measures = lambda c: {"mass": F.coalesce(F.sum(col(c).cast("double")), F.lit(0.0)), "least": F.min(col(c)).cast("double"), "rows": F.count("*")}
    observed = long_stats(drop_null_keys(df, [label]), features, measures, by=[label])
    totals = observed.groupBy(F.col("column").alias("feature")).agg(
        F.sum("mass").alias("whole"), F.sum("rows").alias("all"), F.min("least").alias("least")
    )
    expected = F.col("whole") * F.col("rows") / F.col("all")
    part = F.try_divide((F.col("mass") - expected) * (F.col("mass") - expected), expected)
    scored = (
        observed.withColumnRenamed("column", "feature").join(totals.withColumnRenamed("least", "lowest"), "feature")
        .groupBy("feature")
        .agg(F.when(F.min("lowest") >= 0, F.sum(part)).alias("chi2"))
    )
    order = Window.orderBy(F.desc_nulls_last("chi2"), "feature")  # one row per feature
    return scored.withColumn("rank", F.row_number().over(order).cast("long"))


def best_features(df: DataFrame, label: str, k: int = 10, features: Sequence[str] | None = None) -> list[str]:
    """The names of the ``k`` features with the highest scores, best first."""
    rows = chi2_scores(df, label, features).where(F.col("chi2").isNotNull() & (F.col("rank") <= k)).orderBy("rank")
    return [r["feature"] for r in rows.collect()]  # at most one row per feature
