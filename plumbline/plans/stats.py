"""One-pass statistics and how they reach the rows again."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_list, col

# A table is broadcast only after counting that it has no more rows than this.
BROADCAST_ROWS = 100_000


def one_row(stats: DataFrame) -> Column:
    """A one-row table as a struct column, through a scalar subquery.

    Spark runs the subquery once, before the main plan, and reuses it at every
    mention; the rows are neither joined nor shuffled.
    """
    return stats.select(F.struct("*")).scalar()


def long_stats(
    df: DataFrame,
    columns: Sequence[str],
    measures: Callable[[str], Mapping[str, Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """Statistics of many columns in one aggregate: a row per group and column."""
    cells = [
        F.struct(F.lit(c).alias("column"), *[m.alias(n) for n, m in measures(c).items()])
        for c in columns
    ]
    keys = [col(k) for k in as_list(by)]
    out = df.groupBy(*keys).agg(F.array(*cells).alias("__cells"))
    return out.select(*keys, F.inline("__cells"))


def long_values(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), as_type: str = "double"
) -> DataFrame:
    """Rows ``(by..., column, value)``: one per input row and column."""
    cells = [
        F.struct(F.lit(c).alias("column"), col(c).cast(as_type).alias("value")) for c in columns
    ]
    keys = [col(k) for k in as_list(by)]
    return df.select(*keys, F.inline(F.array(*cells)))


def checked_broadcast(stats: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a statistics table if it is proven small, else leave it alone.

    The aggregate runs once; up to ``max_rows`` rows come back and are embedded
    in the plan. A larger table keeps its plan, is joined by a shuffle, and
    adaptive execution splits partitions of hot keys.
    """
    rows = stats.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return stats
    return F.broadcast(stats.sparkSession.createDataFrame(rows, stats.schema))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all present; a missing key forms no group."""
    for k in keys:
        df = df.where(col(k).isNotNull())
    return df
