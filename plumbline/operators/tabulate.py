"""Counts, shares and means by category."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col, quoted, require
from ..functions.hashing import SPACE, cut, digest
from ..plans.order_stats import ROWS_PER_TASK, quantiles
from ..plans.stats import drop_null_keys, one_row


def value_counts(df: DataFrame, column: str, sort: bool = True) -> DataFrame:
    """``(value, n)``, most frequent first, equal counts by value; missing left out."""
    require(df, column)
    out = df.where(col(column).isNotNull()).groupBy(col(column).alias("value")).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), "value") if sort else out


def value_shares(df: DataFrame, column: str, sort: bool = True) -> DataFrame:
    """``(value, n, share)``: counts divided by the rows that have a value."""
    total = one_row(df.agg(F.count(col(column)).alias("rows"))).getField("rows")
    return value_counts(df, column, sort).withColumn("share", F.col("n") / total)


def pie_shares(df: DataFrame, column: str) -> DataFrame:
    """Shares with the percent label of a pie chart, one decimal."""
    return value_shares(df, column, sort=False).withColumn("percent", F.round(100 * F.col("share"), 1))


def nested_shares(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """The two rings of a nested pie chart."""
    rings = [
        pie_shares(df, c).select(
            F.lit(ring).alias("ring"), F.lit(c).alias("column"), col("value").cast("string").alias("value"), "n", "share", "percent"
        )
        for ring, c in (("outer", outer), ("inner", inner))
    ]
    return rings[0].unionByName(rings[1])


def count_by(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Counts per category, or per category and hue; missing keys left out."""
    columns = require(df, columns)
    return drop_null_keys(df, columns).groupBy(*map(col, columns)).agg(F.count("*").alias("n"))


def levels(df: DataFrame, column: str, max_levels: int = 1_000) -> list:
    """The values that become columns of a crosstab, ascending."""
    rows = df.select(col(column)).where(col(column).isNotNull()).distinct().limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} values; use count_by for the long form")
    return sorted(r[0] for r in rows)


def crosstab(df: DataFrame, index: str, column: str, values: Sequence | None = None, normalize: str | None = None) -> DataFrame:
    """Counts of ``index`` by ``column``, one output column per value.

    ``normalize="index"`` makes each row sum to 1, ``"columns"`` each column.
    The key keeps its type. Giving ``values`` saves the job that lists them.
    """
    require(df, [index, column])
    values = levels(df, column) if values is None else list(values)
    pairs = drop_null_keys(df, [index, column])
    table = pairs.groupBy(col(index)).pivot(quoted(column), values).count().fillna(0)
    names = table.columns[1:]
    if normalize is None:
        return table
    if normalize == "index":
        total = sum((col(n) for n in names), F.lit(0))
        return table.where(total > 0).withColumns({n: col(n) / total for n in names})
    if normalize == "columns":
        totals = one_row(
            pairs.agg(*[F.count_if(col(column) == F.lit(v)).alias(n) for v, n in zip(values, names)])
        )
        return table.withColumns({n: F.try_divide(col(n), totals.getField(n)) for n in names})
    raise ValueError("normalize is None, 'index' or 'columns'")


def crosstab_median(
    df: DataFrame, index: str, value: str, label: str = "Test", column: str | None = None,
    values: Sequence | None = None, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Median of ``value`` per ``index`` under one label, or per value of ``column``."""
    keys = [index] if column is None else [index, column]
    require(df, [*keys, value])
    found = quantiles(df, value, [0.5], keys, rows_per_task)
    median = F.col("quantiles")[0]
    if column is None:
        return found.where(median.isNotNull()).select(col(index), median.alias(label))
    values = levels(df, column) if values is None else list(values)
    return found.groupBy(col(index)).pivot(quoted(column), values).agg(F.first(median))


def group_mean(df: DataFrame, by: str | Sequence[str], value: str, sort: bool = True) -> DataFrame:
    """Mean per group, keys ascending, with the two-decimal bar label."""
    by = require(df, by)
    out = (
        drop_null_keys(df, by)
        .groupBy(*map(col, by))
        .agg(F.avg(col(value)).alias("mean"))
        .withColumn("label", F.round("mean", 2))
    )
    return out.orderBy(*map(col, by)) if sort else out


def group_mean_ci(df: DataFrame, by: str | Sequence[str], value: str, z: float = 1.96) -> DataFrame:
    """Mean per group with its normal 95 % interval; one pass."""
    by = require(df, by)
    out = (
        drop_null_keys(df, by)
        .groupBy(*map(col, by))
        .agg(F.count(col(value)).alias("n"), F.avg(col(value)).alias("mean"), F.stddev_samp(col(value)).alias("__sd"))
    )
    half = F.coalesce(z * F.try_divide(F.col("__sd"), F.sqrt(F.col("n").cast("double"))), F.lit(0.0))
    return out.withColumns({"low": F.col("mean") - half, "high": F.col("mean") + half}).drop("__sd")


DRAWS = 4  # of 32 bits each, out of one digest
BLOCKS = 4096


def poisson_cuts() -> list[float]:
    """Cumulative probabilities of the Poisson distribution with mean 1, as far as 32 bits tell them from 1."""
    out, part, total = [], math.exp(-1), 0.0
    while int((total + part) * SPACE) < SPACE - 1:
        total += part
        out.append(total)
        part /= len(out)
    return out


def group_mean_bootstrap(
    df: DataFrame, by: str | Sequence[str], value: str, key: str | Sequence[str],
    replicates: int = 1_000, level: float = 0.95, seed: int = 0, blocks: int = BLOCKS,
) -> DataFrame:
    """Mean per group with a bootstrap percentile interval: ``(by..., mean, low, high)``.

    Rows fall into ``blocks`` by a hash of their key and are summed per block, in
    one pass that combines before the shuffle. A block of a group draws one Poisson(1) weight for
    each replicate, as one vector; vectors are added up per group before and after the
    shuffle, so no row per replicate is made and the cost does not grow with the rows. In a
    small group nearly every row is a block of its own.
    """
    by, key = require(df, by), require(df, key)
    block = F.conv(digest(key, f"block-{seed}"), 16, 10).cast("long") % F.lit(blocks)
    summed = (
        drop_null_keys(df, [*by, value])
        .groupBy(*map(col, by), block.alias("__block"))
        .agg(F.sum(col(value).cast("double")).alias("__sum"), F.count("*").alias("__n"))
    )
    text = F.concat_ws("|", *[col(b).cast("string") for b in by], F.col("__block").cast("string"))
    digests = F.transform(
        F.sequence(F.lit(0), F.lit(math.ceil(replicates / DRAWS) - 1)),
        lambda i: F.md5(F.concat(text, F.lit("|"), i.cast("string"), F.lit(f"-{seed}"))),
    )
    draws = F.slice(F.flatten(F.transform(digests, lambda d: F.array(*[F.substring(d, 8 * p + 1, 8) for p in range(DRAWS)]))), 1, replicates)

    def weight(draw: Column) -> Column:  # most draws are settled by the first comparisons
        cuts = poisson_cuts()
        out = F.when(draw < F.lit(cut(cuts[0])), 0.0)
        for i, c in enumerate(cuts[1:], 1):
            out = out.when(draw < F.lit(cut(c)), float(i))
        return out.otherwise(float(len(cuts)))

    weights = F.transform(draws, weight)
    scaled = F.flatten(F.transform(weights, lambda w: F.array(w * F.col("__sum"), w * F.col("__n"))))
    totals = summed.groupBy(*map(col, by)).agg(
        vector_to_array(Summarizer.sum(array_to_vector(scaled))).alias("__t"), (F.sum("__sum") / F.sum("__n")).alias("mean")
    )
    means = F.transform(
        F.sequence(F.lit(0), F.lit(replicates - 1)), lambda r: F.try_divide(F.get("__t", 2 * r), F.get("__t", 2 * r + 1))
    )
    found = totals.withColumn("__m", F.sort_array(F.filter(means, lambda m: m.isNotNull())))
    tail = (1 - level) / 2

    def at(share: float) -> Column:
        place = (F.size("__m") - 1) * F.lit(share)
        least, part = F.floor(place).cast("int"), place - F.floor(place)
        return F.get("__m", least) * (1 - part) + F.get("__m", F.ceil(place).cast("int")) * part

    return found.select(*map(col, by), "mean", at(tail).alias("low"), at(1 - tail).alias("high"))
