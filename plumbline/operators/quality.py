"""Missing values and duplicate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import as_list, col, require
from ..plans.storage import cut_lineage
from ..plans.stats import drop_null_keys, long_stats, one_row


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)``, all columns in one pass."""
    columns = require(df, columns or df.columns)
    return long_stats(df, columns, lambda c: {"nulls": F.count_if(col(c).isNull())})


def missing_pct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing_pct)``: missing values per hundred rows."""
    columns = require(df, columns or df.columns)
    return long_stats(
        df,
        columns,
        lambda c: {
            "missing_pct": F.try_divide(F.count_if(col(c).isNull()) * F.lit(100.0), F.count("*"))
        },
    )


def midrange_impute(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Fill missing values with half of maximum plus minimum of the column."""
    columns = require(df, columns)
    middle = one_row(df.agg(*[((F.max(col(c)) + F.min(col(c))) / 2).alias(c) for c in columns]))
    return df.withColumns(
        {c: F.coalesce(col(c).cast("double"), middle.getField(c)) for c in columns}
    )


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value."""
    return drop_null_keys(df, require(df, columns or df.columns))


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    """One row per combination; a missing value equals a missing value.

    Over all columns the copies cannot be told apart. Over some columns the
    row with the lowest ``key`` stays, a missing key last.
    """
    if columns is None:
        return df.distinct()
    columns = require(df, columns)
    if key is None:
        raise ValueError("a key must say which of several different rows comes first")
    rest = [c for c in df.columns if c not in columns]
    kept = F.min_by(F.struct(*map(col, rest)), F.struct(col(key).isNull(), col(key))).alias("__kept")
    out = df.groupBy(*map(col, columns)).agg(kept)
    return out.select(*[F.col("__kept").getField(c).alias(c) if c in rest else col(c) for c in df.columns])


def mark_duplicates(
    df: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None, marker: str = "is_duplicate"
) -> DataFrame:
    """False on the first row of each combination in key order, true on later ones.

    The first keys come from a grouped minimum, which is combined before the shuffle, and
    are matched back by key and combination, in which missing values are equal and a missing key comes
    last. Of rows that agree in both, one is the first: they are numbered apart, and only where a
    first key repeats, so a combination with very many copies never meets in one task.
    """
    keys = require(df, key)
    columns = require(df, columns or [c for c in df.columns if c not in keys])
    ordered = F.struct(*[f for k in keys for f in (col(k).isNull(), col(k))])
    rows = df.select(
        F.struct("*").alias("__row"), F.struct(*map(col, columns)).alias("__same"), ordered.alias("__place"),
        F.monotonically_increasing_id().alias("__id"),
    )
    first = df.groupBy(*map(col, columns)).agg(F.min(ordered).alias("__least"))
    first = first.select(F.struct(*map(col, columns)).alias("__group"), "__least")
    same = lambda group, place: F.col("__same").eqNullSafe(F.col(group)) & F.col("__place").eqNullSafe(F.col(place))
    several = not df.groupBy(*map(col, dict.fromkeys([*columns, *keys]))).count().where("count > 1").isEmpty()
    if several:
        rows = cut_lineage(rows)  # row numbers hold from here on
    marked = rows.join(first, same("__group", "__least"), "left").withColumn("__lead", F.col("__least").isNotNull())
    if not several:  # keys are unique within each combination
        return marked.select("__row.*", (~F.col("__lead")).alias(marker))
    one = marked.where("__lead").groupBy("__same", "__place").agg(F.min("__id").alias("__one"))
    leads = marked.join(one.select("__one"), F.col("__id") == F.col("__one"), "left")
    return leads.select("__row.*", F.col("__one").isNull().alias(marker))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(duplicates)``: rows that repeat an earlier one."""
    groups = df.groupBy(*map(col, require(df, columns or df.columns))).count()
    return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def quality_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column and the number of duplicate rows, as ``(measure, value)``.

    Both come from the grouped copies: the table is read and shuffled once.
    """
    columns = require(df, as_list(columns) or df.columns)
    groups = df.groupBy(*map(col, columns)).agg(F.count("*").alias("__copies"))
    cells = [
        F.struct(
            F.lit(c).alias("measure"),
            F.coalesce(F.sum(F.when(col(c).isNull(), F.col("__copies"))), F.lit(0)).alias("value"),
        )
        for c in columns
    ]
    extra = F.struct(
        F.lit("__duplicates__").alias("measure"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("value"),
    )
    return groups.agg(F.array(*cells, extra).alias("__cells")).select(F.inline("__cells"))
