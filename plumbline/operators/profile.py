"""Shape, types and summary statistics. Every table is read once or twice, never per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, numbers, require, text_columns
from ..plans.order_stats import ROWS_PER_TASK, approximate_quantiles, quantiles
from ..plans.stats import long_stats, long_values


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_columns)``."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def info(df: DataFrame) -> DataFrame:
    """``(position, column, non_null, dtype)``."""
    place = {c: i for i, c in enumerate(df.columns)}
    kinds = dict(df.dtypes)
    found = long_stats(
        df,
        df.columns,
        lambda c: {
            "non_null": F.count(col(c)),
            "dtype": F.lit(kinds[c]),
            "position": F.lit(place[c]).cast("bigint"),
        },
    )
    return found.select("position", "column", "non_null", "dtype")


def dtypes(df: DataFrame) -> DataFrame:
    """``(column, dtype)``, from the schema alone."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    columns = numbers(df, columns)
    moments = long_stats(
        df,
        columns,
        lambda c: {
            "count": F.count(col(c)),
            "mean": F.avg(col(c)),
            "std": F.stddev_samp(col(c)),
            "min": F.min(col(c)).cast("double"),
            "max": F.max(col(c)).cast("double"),
        },
    )
    marks = quantiles(df, columns, [0.25, 0.5, 0.75], rows_per_task=rows_per_task)
    q = F.col("quantiles")
    # one row per column of the schema on both sides
    return moments.join(F.broadcast(marks), "column").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        q[0].alias("q25"),
        q[1].alias("q50"),
        q[2].alias("q75"),
        "max",
    )


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per text column.

    Equal frequencies: the lower value. Values are counted once per distinct
    value before they meet per column.
    """
    columns = require(df, columns) if columns is not None else text_columns(df)
    counted = (
        long_values(df, columns, as_type="string")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    found = counted.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left").fillna(0, ["count", "unique"])


def column_means(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return long_stats(df, numbers(df, columns), lambda c: {"mean": F.avg(col(c))})


def column_stds(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Sample standard deviations."""
    return long_stats(df, numbers(df, columns), lambda c: {"std": F.stddev_samp(col(c))})


def std_of_stds(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Population deviation of the columns' sample deviations: one number."""
    return column_stds(df, columns).agg(F.stddev_pop("std").alias("std_of_stds"))


def column_medians(
    df: DataFrame, columns: Sequence[str] | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    found = quantiles(df, numbers(df, columns), [0.5], rows_per_task=rows_per_task)
    return found.select("column", F.col("quantiles")[0].alias("median"))


def column_extremes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return long_stats(
        df, numbers(df, columns), lambda c: {"min": F.min(col(c)).cast("double"), "max": F.max(col(c)).cast("double")}
    )


def quantile_table(
    df: DataFrame,
    columns: str | Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``(by..., column, q, value)``; exact unless an accuracy is given."""
    require(df, columns)
    if accuracy is None:
        found = quantiles(df, columns, probs, by, rows_per_task)
    else:
        found = approximate_quantiles(df, columns, probs, by, accuracy)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("q"), F.col("quantiles").alias("value"))
    return found.select(*map(col, by), "column", F.inline(pairs)).toDF(*by, "column", "q", "value")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """``(column, n_distinct)``, missing values not counted.

    Spark deduplicates the values per column before and after the shuffle and
    only then counts, so no task holds all values of a column.
    """
    columns = require(df, columns or df.columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    return long_stats(df, columns, lambda c: {"n_distinct": count(col(c))})


def unique_values(df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """``(column, value)``: the distinct values as text, a missing value included."""
    columns = [c for c in require(df, columns or df.columns) if c not in set(exclude)]
    return long_values(df, columns, as_type="string").distinct()
