"""The aggregates behind charts: boxes, histograms, densities, violins.

On large data only the aggregate can be drawn, so each operator returns the
few rows a chart shows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import as_list, col, numbers, require
from ..plans.order_stats import ROWS_PER_TASK, quantiles
from ..plans.stats import checked_broadcast, drop_null_keys, long_stats, long_values, one_row
from .outliers import fence_row, iqr_fences

GRID_POINTS = 200
VIOLIN_POINTS = 100


def box_stats(
    df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and points beyond, per column."""
    columns = numbers(df, columns)
    fences = checked_broadcast(iqr_fences(df, columns, k=k, rows_per_task=rows_per_task))
    limits = fence_row(fences, columns)

    def measures(c):
        low, high = limits.getField(c).getField("low"), limits.getField(c).getField("high")
        inside = F.when(col(c).between(low, high), col(c).cast("double"))
        return {
            "whisker_low": F.min(inside),
            "whisker_high": F.max(inside),
            "n_outliers": F.count_if((col(c) < low) | (col(c) > high)),
        }

    return fences.join(F.broadcast(long_stats(df, columns, measures)), "column").select(
        "column", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers"
    )


def box_stats_by(
    df: DataFrame, by: str | Sequence[str], value: str, k: float = 1.5, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The same per group of one column."""
    by = require(df, by)
    keyed = drop_null_keys(df.select(*map(col, [*by, value])), by)
    fences = checked_broadcast(iqr_fences(keyed, [value], k=k, by=by, rows_per_task=rows_per_task).drop("column"))
    inside = F.when(col(value).between(F.col("low"), F.col("high")), col(value).cast("double"))
    return (
        keyed.join(fences, by)
        .groupBy(*map(col, by), "q1", "median", "q3")
        .agg(
            F.min(inside).alias("whisker_low"),
            F.max(inside).alias("whisker_high"),
            F.count_if((col(value) < F.col("low")) | (col(value) > F.col("high"))).alias("n_outliers"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int | None = None, width_target: float = 30.0) -> DataFrame:
    """Equal-width bins on ``[min, max]``, the last one closed, empty ones included.

    Without ``bins`` their number is the range divided by ``width_target``,
    cut to an integer, at least 1. Output: bin, left, right, n.
    """
    require(df, column)
    x = col(column).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    number = (
        F.lit(bins)
        if bins is not None
        else F.greatest(F.lit(1), F.floor((F.col("hi") - F.col("lo")) / width_target)).cast("long")
    )
    flat = F.col("lo") == F.col("hi")  # one value only: half a unit to each side
    ends = ends.where(F.col("lo").isNotNull()).select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        number.cast("long").alias("bins"),
    )
    e = one_row(ends)
    width = (e["hi"] - e["lo"]) / e["bins"]
    place = F.least(F.floor((x - e["lo"]) / width).cast("long"), e["bins"] - 1)
    filled = df.where(x.isNotNull()).select(place.alias("bin"), F.lit(1).alias("__n"))
    found = ends.first()  # bins come from a range, which many tasks make
    empty = df.sparkSession.range(found["bins"] if found else 0).select(F.col("id").alias("bin"), F.lit(0).alias("__n"))
    return (
        filled.unionAll(empty)
        .groupBy("bin")
        .agg(F.sum("__n").alias("n"))
        .select(
            "bin",
            (e["lo"] + F.col("bin") * width).alias("left"),
            (e["lo"] + (F.col("bin") + 1) * width).alias("right"),
            "n",
        )
    )


TERMS = 16  # of the expansion of the kernel; an error below 1e-11 for each value, whose kernel has the height 1
REACH = 9.0  # bandwidths; the kernel is below 1e-17 beyond


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients of the Hermite polynomials whose weight is ``exp(-v * v / 2)``, lowest power first."""
    out = [[1], [0, 1]]
    for k in range(1, terms - 1):
        longer, before = [0, *out[k]], [*out[k - 1], 0, 0]
        out.append([a - k * b for a, b in zip(longer, before)])
    return out[:terms]


def kde_curve(
    df: DataFrame, column: str, by: str | Sequence[str] = (), points: int = GRID_POINTS,
    cut: float = 0.0, bins: int | None = None, fine_bins: int | None = None,
) -> DataFrame:
    """Gaussian density on an even grid, with Scott's bandwidth per group.

    The grid covers the data and ``cut`` bandwidths on each side. The kernel sums are
    a fast Gauss transform: values fall into cells of one bandwidth, one hash aggregate takes ``TERMS`` moments of each
    cell, and the moments are expanded at the grid points that the cell reaches. What is shuffled grows with
    the occupied cells, not with values or their products with the grid. Each value's
    kernel is off by less than 1e-11 of its height. ``bins`` adds ``frequency``, the curve in the scale of a
    histogram with that many bins. ``fine_bins`` first moves values
    to the centre of one of so many cells. A group without spread has no curve. Output: by, point, x, density.
    """
    by = require(df, by)
    keys = [f"__g{i}" for i in range(len(by))]
    value = col(column).cast("double")
    rows = drop_null_keys(df.select(*[col(b).alias(k) for b, k in zip(by, keys)], value.alias("__x")), [*keys, "__x"])
    stats = (
        rows.groupBy(*keys)
        .agg(
            F.count("*").alias("__n"),
            F.stddev_samp("__x").alias("__sd"),
            F.min("__x").alias("__min"),
            F.max("__x").alias("__max"),
        )
        .where(F.col("__min") < F.col("__max"))
        .withColumn("__h", F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2)))
        .select(
            *keys,
            "__n",
            "__h",
            "__min",
            "__max",
            (F.col("__min") - cut * F.col("__h")).alias("__lo"),
            (F.col("__max") + cut * F.col("__h")).alias("__hi"),
        )
    )
    measures = ("__n", "__h", "__min", "__max", "__lo", "__hi")
    if by:
        stats = checked_broadcast(stats)
        attach = lambda d: d.join(stats, keys)
        s = {c: F.col(c) for c in measures}
    else:
        attach = lambda d: d
        row = one_row(stats)
        s = {c: row.getField(c) for c in measures}
    placed = attach(rows).select(*keys, "__x", *[s[c].alias(c) for c in measures]).where("__h IS NOT NULL")
    if fine_bins:
        width = (F.col("__max") - F.col("__min")) / fine_bins
        snapped = F.col("__min") + (F.least(F.floor((F.col("__x") - F.col("__min")) / width), F.lit(fine_bins - 1)) + 0.5) * width
        placed = placed.withColumn("__x", snapped)
    far = (F.col("__x") - F.col("__min")) / F.col("__h")
    placed = placed.select(*keys, F.floor(far).alias("__cell"), (far - F.floor(far) - 0.5).alias("__u"))
    power, moments = F.lit(1.0), []
    for k in range(TERMS):
        moments.append((F.sum(power) / math.factorial(k)).alias(f"__m{k}"))
        power = power * F.col("__u")
    cells = attach(placed.groupBy(*keys, "__cell").agg(*moments))
    step = (s["__hi"] - s["__lo"]) / (points - 1)
    center = s["__min"] + (F.col("__cell") + 0.5) * s["__h"]
    polynomials = _hermite(TERMS)
    weights = [
        sum((F.col(f"__m{k}") * float(c[j]) for k, c in enumerate(polynomials) if j < len(c) and c[j]), F.lit(0.0)).alias(f"__a{j}")
        for j in range(TERMS)
    ]
    first = F.greatest(F.lit(0.0), F.ceil((center - REACH * s["__h"] - s["__lo"]) / step)).cast("int")
    last = F.least(F.lit(points - 1.0), F.floor((center + REACH * s["__h"] - s["__lo"]) / step)).cast("int")
    spread = cells.select(
        *keys, center.alias("__c"), s["__lo"].alias("__lo"), step.alias("__step"), s["__h"].alias("__h"), *weights,
        first.alias("__first"), last.alias("__last"),
    ).where("__first <= __last")
    spread = spread.withColumn("__point", F.explode(F.sequence("__first", "__last")))
    spread = spread.withColumn("__v", (F.col("__lo") + F.col("__point") * F.col("__step") - F.col("__c")) / F.col("__h"))
    total = F.col(f"__a{TERMS - 1}")
    for j in reversed(range(TERMS - 1)):
        total = total * F.col("__v") + F.col(f"__a{j}")
    parts = spread.select(*keys, "__point", (total * F.exp(-0.5 * F.col("__v") * F.col("__v"))).alias("__part"))
    grid = stats.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("__point"), F.lit(0.0).alias("__part"))
    sums = attach(parts.unionByName(grid).groupBy(*keys, "__point").agg(F.greatest(F.sum("__part"), F.lit(0.0)).alias("__sum")))
    density = F.col("__sum") / (s["__n"] * s["__h"] * math.sqrt(2 * math.pi))
    return sums.select(
        *[F.col(k).alias(b) for k, b in zip(keys, by)], F.col("__point").alias("point"),
        (s["__lo"] + F.col("__point") * step).alias("x"), density.alias("density"),
        *([(density * s["__n"] * (s["__max"] - s["__min"]) / bins).alias("frequency")] if bins else []),
    )


def violin_stats(
    df: DataFrame, columns: Sequence[str] | None = None, points: int = VIOLIN_POINTS, cut: float = 0.0,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Density and quartiles of several columns, drawn within their range."""
    columns = numbers(df, columns)
    curves = kde_curve(long_values(df, columns), "value", by="column", points=points, cut=cut)
    marks = quantiles(df, columns, [0.25, 0.5, 0.75], rows_per_task=rows_per_task)
    return _with_quartiles(curves, marks, ["column"])


def violin_by_hue(
    df: DataFrame, x: str, y: str, hue: str, points: int = VIOLIN_POINTS, cut: float = 2.0,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Density and quartiles of ``y`` per category and hue."""
    curves = kde_curve(df, y, by=[x, hue], points=points, cut=cut).withColumnRenamed("x", "__grid")
    marks = quantiles(df, y, [0.25, 0.5, 0.75], by=[x, hue], rows_per_task=rows_per_task).drop("column")
    return _with_quartiles(curves, marks, [x, hue]).withColumnRenamed("__grid", "y")


def _with_quartiles(curves: DataFrame, marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    q = F.col("quantiles")
    marks = checked_broadcast(
        marks.select(*map(col, as_list(keys)), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"))
    )
    return curves.join(marks, list(keys))
