"""Running totals over a total order, without sorting everything in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import col

ROWS_PER_SORT = 1_000_000  # narrow rows, so more than a task should hold as a map
MAX_RANGES = 10_000


def range_splits(source: DataFrame, column: str, rows_per_task: int = ROWS_PER_SORT) -> list[float]:
    """Cut points that divide the rows into ranges of a size one task can sort."""
    ranges = min(MAX_RANGES, math.ceil(source.count() / rows_per_task))
    if ranges < 2:
        return []
    probs = [i / ranges for i in range(1, ranges)]
    found = source.select(col(column).cast("double").alias("v")).approxQuantile("v", probs, 0.25 / ranges)
    return sorted(set(found))


def in_ranges(table: DataFrame, order: str, splits: Sequence[float]) -> DataFrame:
    """Adds ``__range``: the number of the range of each row."""
    if not splits:
        return table.withColumn("__range", F.lit(0))
    cuts = [-math.inf, *splits, math.inf]
    ranged = Bucketizer(splits=cuts, inputCol=order, outputCol="__range").transform(table)
    return ranged.withColumn("__range", F.col("__range").cast("int"))


def running_totals(counts: DataFrame, order: str, totals: Sequence[str], splits: Sequence[float]) -> DataFrame:
    """One row per value of ``order``: its totals, and those of all larger values.

    ``counts`` has a row per value, so no value is heavy. Each range of
    values is summed on its own and shifted by the sum of the ranges above it;
    the table of range sums has ``len(splits) + 1`` rows. Without splits the
    whole table is known to be one range.
    """
    before = lambda w, t: F.coalesce(F.sum(col(t)).over(w), F.lit(0))
    upwards = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("__range").orderBy(col(order).desc()).rowsBetween(*upwards)
    counts = in_ranges(counts, order, splits)
    summed = counts.withColumns({f"{t}_before": before(inside, t) for t in totals})
    if not splits:
        return summed
    sums = counts.groupBy("__range").agg(*[F.sum(col(t)).alias(t) for t in totals])
    over_ranges = Window.orderBy(F.desc("__range")).rowsBetween(*upwards)
    above = sums.select("__range", *[before(over_ranges, t).alias(f"__above_{t}") for t in totals])
    return (
        summed.join(F.broadcast(above), "__range")
        .withColumns({f"{t}_before": col(f"{t}_before") + col(f"__above_{t}") for t in totals})
        .drop(*[f"__above_{t}" for t in totals])
    )
