"""Interquartile fences and what lies beyond them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, numbers
from ..plans.order_stats import ROWS_PER_TASK, quantiles
from ..plans.stats import one_row


def iqr_fences(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = (),
    k: float = 1.5, by: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``(by..., column, q1, median, q3, low, high)``, all columns together."""
    found = quantiles(df, numbers(df, columns, exclude), [0.25, 0.5, 0.75], by, rows_per_task)
    q = F.col("quantiles")
    return found.select(
        *map(col, by), "column", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")
    ).withColumns(
        {
            "low": F.col("q1") - k * (F.col("q3") - F.col("q1")),
            "high": F.col("q3") + k * (F.col("q3") - F.col("q1")),
        }
    )


def fence_row(fences: DataFrame, columns: Sequence[str]):
    """The fences as one struct, ``column -> (low, high)``; one field per column."""
    pair = F.struct("low", "high")
    wide = fences.agg(*[F.max(F.when(F.col("column") == c, pair)).alias(c) for c in columns])
    return one_row(wide)


def iqr_clean(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = (),
    k: float = 1.5, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows inside the fences of every column.

    The fences come from the whole table. A missing value drops the row. A
    0/1 column whose quartiles agree loses its rare value: use ``exclude``.
    """
    columns = numbers(df, columns, exclude)
    limits = fence_row(iqr_fences(df, columns, k=k, rows_per_task=rows_per_task), columns)
    keep = F.lit(True)
    for c in columns:
        keep = keep & col(c).between(limits.getField(c).getField("low"), limits.getField(c).getField("high"))
    return df.where(keep)


def iqr_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = (),
    k: float = 1.5, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows outside a fence: ``(outlier_column, outlier_value, row...)``.

    A row outside several fences appears once per column. The table is read
    once for all columns and is not shuffled.
    """
    columns = numbers(df, columns, exclude)
    limits = fence_row(iqr_fences(df, columns, k=k, rows_per_task=rows_per_task), columns)
    hits = []
    for c in columns:
        low, high = limits.getField(c).getField("low"), limits.getField(c).getField("high")
        hit = F.struct(F.lit(c).alias("outlier_column"), col(c).cast("double").alias("outlier_value"))
        hits.append(F.when((col(c) < low) | (col(c) > high), hit))
    return df.select(F.inline(F.array_compact(F.array(*hits))), "*")
