"""Exact quantiles that never put an unbounded group into one task.

``percentile`` keeps one entry per distinct value of a group in one task. That
is right while a group is known to be small, so groups are counted first:

* a group of at most ``rows_per_task`` rows uses ``percentile``;
* with very many groups, those of up to ``rows / BROADCAST_ROWS`` rows are
  sorted, which can spill, and read at the wanted ranks;
* a larger group is narrowed. A pass over the table counts the values of an
  interval in equal bins, with the least and greatest value of each; the bin
  that holds a wanted rank is the interval of the next pass. It ends at a
  single value, or where few enough values are left to be sorted. No pass
  shuffles more than bin counts, and every count is exact.

Fewer than ``BROADCAST_ROWS`` groups are narrowed, which bounds the state the
driver holds between passes.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.columns import as_list, col
from .stats import BROADCAST_ROWS, drop_null_keys, long_stats, long_values

ROWS_PER_TASK = 250_000
BINS = 4_096
ACCURACY = 10_000  # a sketch's rank error is 1 / ACCURACY


def quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probs: Sequence[float],
    by: str | Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation: ``(by..., column, quantiles)``.

    ``quantiles`` is an array in the order of ``probs``; NULL for a column
    without values. Missing values are skipped, rows with a missing key too.
    A caller that knows the number of ``rows`` saves the job that counts them.
    """
    columns, by, probs = as_list(columns), as_list(by), [float(p) for p in probs]
    clash = {"column", "value", "interval", "low", "high", "n", "quantiles", "count"}
    if clash & set(by):  # group keys that have names used here
        names = {b: f"__by_{i}" for i, b in enumerate(by)}
        renamed = df.select("*", *[col(b).alias(n) for b, n in names.items()])
        found = quantiles(renamed, columns, probs, list(names.values()), rows_per_task, rows)
        return found.select(*[F.col(n).alias(b) for b, n in names.items()], "column", "quantiles")
    keyed = drop_null_keys(df, by)
    rows = keyed.count() if rows is None else rows
    if rows * len(columns) <= rows_per_task:
        return _in_one_pass(keyed, columns, probs, by)
    if rows <= rows_per_task:
        return _per_column(keyed, columns, probs, by)
    if not by:
        return _narrowed(keyed, columns, probs, [], None, rows_per_task)
    keys = [col(k) for k in by]
    most = max(rows_per_task, math.ceil(rows / BROADCAST_ROWS))
    large = keyed.groupBy(*keys).count().where(F.col("count") > most).drop("count")
    found = large.collect()  # fewer than BROADCAST_ROWS groups can be so large
    others = _per_column if most == rows_per_task else _sorted_per_column
    if not found:
        return others(keyed, columns, probs, by)
    groups = F.broadcast(df.sparkSession.createDataFrame(found, large.schema))
    small = others(keyed.join(groups, by, "left_anti"), columns, probs, by)
    return small.unionByName(_narrowed(keyed, columns, probs, by, groups, rows_per_task))


def approximate_quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probs: Sequence[float],
    by: str | Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """The same table from one pass of mergeable sketches."""
    by = as_list(by)
    probs = [float(p) for p in probs]
    return long_stats(
        drop_null_keys(df, by),
        as_list(columns),
        lambda c: {"quantiles": F.percentile_approx(col(c).cast("double"), probs, accuracy)},
        by,
    )


def _in_one_pass(df, columns, probs, by):
    return long_stats(
        df, columns, lambda c: {"quantiles": F.percentile(col(c).cast("double"), probs)}, by
    )


def _per_column(df, columns, probs, by):
    return (
        long_values(df, columns, by)
        .groupBy(*[col(k) for k in by], "column")
        .agg(F.percentile("value", probs).alias("quantiles"))
    )


def _sorted_per_column(df, columns, probs, by):
    cell = [*map(col, by), F.col("column")]
    values = long_values(df, columns, by)
    order = Window.partitionBy(*cell).orderBy(F.col("value").asc_nulls_last())
    ranked = values.withColumns(
        {
            "__rank": F.row_number().over(order) - 1,
            "__n": F.count("value").over(Window.partitionBy(*cell)),
        }
    )
    places = [(F.col("__n") - 1) * p for p in probs]
    at = lambda rank: F.max(F.when(F.col("__rank") == rank, F.col("value")))
    found = []
    for place in places:
        part = F.max(place - F.floor(place))
        first = at(F.floor(place))
        found.append(F.when(part == 0, first).otherwise(first * (1 - part) + at(F.ceil(place)) * part))
    return ranked.groupBy(*cell).agg(
        F.when(F.max("__n") > 0, F.array(*found)).alias("quantiles")
    )


@dataclass
class _Interval:
    """Values of one cell from ``low`` to ``high``; ``below`` of its values are less."""

    cell: tuple
    below: int
    low: float
    high: float
    ranks: list[int]


def _narrowed(df, columns, probs, by, groups, rows_per_task):
    spark = df.sparkSession
    if groups is not None:
        df = df.join(groups, by, "left_semi")
    ends = long_stats(
        df,
        columns,
        lambda c: {
            "n": F.count(col(c)),
            "low": F.min(col(c)).cast("double"),
            "high": F.max(col(c)).cast("double"),
        },
        by,
    )
    cell = [*by, "column"]
    cell_fields = [f for f in ends.schema.fields if f.name in cell]

    places, answers, wanted = {}, {}, defaultdict(set)
    bins = []
    for row in ends.collect():
        key = tuple(row[k] for k in cell)
        places[key] = [p * (row["n"] - 1) for p in probs] if row["n"] else None
        for place in places[key] or []:
            wanted[key] |= {math.floor(place), math.ceil(place)}
        if row["n"]:
            bins.append((key, 0, row["n"], row["low"], row["high"]))
    few = []
    while bins:
        many = []
        for key, below, n, low, high in bins:
            ranks = sorted(r for r in wanted[key] if below <= r < below + n)
            if low == high or (math.isnan(low) and math.isnan(high)):
                answers.update({(key, r): low for r in ranks})
            else:
                (few if n <= rows_per_task else many).append(_Interval(key, below, low, high, ranks))
        bins = []
        if many:
            inside = _inside(df, columns, by, cell_fields, many)
            for row in _occupied_bins(inside, many).collect():
                bins.append((many[row["interval"]].cell, row["start"], row["n"], row["least"], row["greatest"]))
    if few:
        inside = _inside(df, columns, by, cell_fields, few)
        for row in _values_at_ranks(inside, few).collect():
            it = few[row["interval"]]
            answers.update({(it.cell, r): v for r, v in zip(it.ranks, row["found"])})

    rows = []
    for key, spots in places.items():
        found = None
        if spots is not None:
            found = []
            for place in spots:
                first, last = answers[key, math.floor(place)], answers[key, math.ceil(place)]
                part = place - math.floor(place)
                found.append(first * (1 - part) + last * part if part else first)  # an endless value times 0 is no number
        rows.append((*key, found))
    fields = [*cell_fields, T.StructField("quantiles", T.ArrayType(T.DoubleType()))]
    return spark.createDataFrame(rows, T.StructType(fields))


def _inside(df, columns, by, cell_fields, intervals):
    """``(interval, low, high, value)``: the values that lie in an interval.

    Whole-table intervals are literals in the scan's projection; those of
    groups come from a broadcast table of at most a few rows per group.
    """
    if not by:
        cells = []
        for i, it in enumerate(intervals):
            value = col(it.cell[0]).cast("double")
            hit = F.struct(
                F.lit(i).alias("interval"), F.lit(it.low).alias("low"), F.lit(it.high).alias("high"), value.alias("value")
            )
            cells.append(F.when(value.between(it.low, it.high), hit))
        return df.select(F.inline(F.array(*cells))).where(F.col("interval").isNotNull())
    schema = T.StructType(
        [
            *cell_fields,
            T.StructField("interval", T.IntegerType()),
            T.StructField("low", T.DoubleType()),
            T.StructField("high", T.DoubleType()),
        ]
    )
    rows = [(*it.cell, i, it.low, it.high) for i, it in enumerate(intervals)]
    table = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    return (
        long_values(df, columns, by)
        .join(table, [*by, "column"])
        .where(F.col("value").between(F.col("low"), F.col("high")))
        .select("interval", "low", "high", "value")
    )


def _rank_table(spark, intervals):
    rows = [(i, it.below, it.ranks) for i, it in enumerate(intervals)]
    return F.broadcast(spark.createDataFrame(rows, "interval int, below long, ranks array<long>"))


def _occupied_bins(inside, intervals):
    """The bins of the intervals that hold a wanted rank, with exact counts."""
    half = lambda c: F.col(c) / 2  # the width of an interval of finite values stays finite
    share = (half("value") - half("low")) / (half("high") - half("low"))
    even = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
    # an infinite or NaN end gets a bin of its own, so every pass narrows the interval
    at_end = F.when(F.col("value") == F.col("low"), 0).when(F.col("value") == F.col("high"), BINS - 1).otherwise(BINS // 2)
    endless = lambda c: F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    bin_number = F.when(endless("low") | endless("high"), at_end).otherwise(even)
    counted = inside.groupBy("interval", bin_number.alias("bin")).agg(
        F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest")
    )
    # one interval has at most BINS rows here
    earlier = Window.partitionBy("interval").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(
        _rank_table(inside.sparkSession, intervals), "interval"
    )
    start = F.col("below") + F.col("before")
    holds = F.exists("ranks", lambda r: (r >= start) & (r < start + F.col("n")))
    return placed.where(holds).select("interval", start.alias("start"), "n", "least", "greatest")


def _values_at_ranks(inside, intervals):
    """Sorts the few values of each interval and picks the wanted ones."""
    return (
        inside.groupBy("interval")
        .agg(F.sort_array(F.collect_list("value")).alias("__sorted"))
        .join(_rank_table(inside.sparkSession, intervals), "interval")
        .select(
            "interval",
            F.transform("ranks", lambda r: F.get("__sorted", (r - F.col("below")).cast("int"))).alias("found"),
        )
    )
