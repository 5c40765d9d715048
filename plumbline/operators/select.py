"""Columns, rows by order, and guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_list, col, numeric_columns, require
from ..plans.stats import BROADCAST_ROWS


def select_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    return df.select(*map(col, require(df, columns)))


def by_position(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Columns by position, with the meaning of a Python slice."""
    return df.select(*map(col, df.columns[start:stop]))


def all_but_last(df: DataFrame) -> DataFrame:
    return by_position(df, None, -1)


def drop_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop columns; a name that is absent is an error."""
    return df.drop(*require(df, columns))


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*map(col, numeric_columns(df)))


def put_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or overwrite columns in one projection."""
    return df.withColumns(dict(columns))


def outside(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows below ``low`` or above ``high``; a missing value is not kept."""
    return df.where((col(column) < low) | (col(column) > high))


def within(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows in the closed range; a missing value is not kept."""
    return df.where(col(column).between(low, high))


def column_guard(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Per wanted column: is it there, and has it more than one value?

    Only columns that exist are read. Two different values exist exactly if
    the minimum and the maximum differ, so no distinct count is needed.
    """
    columns = as_list(columns)
    cells = []
    for c in columns:
        there = c in df.columns
        varied = F.coalesce(F.min(col(c)) < F.max(col(c)), F.lit(False)) if there else F.lit(False)
        cells.append(
            F.struct(F.lit(c).alias("column"), F.lit(there).alias("present"), varied.alias("usable"))
        )
    return df.agg(F.count_if(F.lit(False)).alias("n"), F.array(*cells).alias("cells")).select(F.inline("cells"))


def is_usable(df: DataFrame, columns: str | Sequence[str]) -> bool:
    """All columns exist and vary; the data is read only if all exist."""
    columns = as_list(columns)
    if any(c not in df.columns for c in columns):
        return False
    return all(r["usable"] for r in column_guard(df, columns).collect())


def head(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in the order of a key."""
    return df.orderBy(*map(col, require(df, order_by))).limit(n)


def tail(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """Last ``n`` rows in the order of a key, in ascending order."""
    keys = require(df, order_by)
    return df.orderBy(*[col(k).desc() for k in keys]).limit(n).orderBy(*map(col, keys))


def sort_desc(df: DataFrame, column: str, tie: str | Sequence[str] = (), skip: int = 0) -> DataFrame:
    """Descending by a column, ties ascending by keys, the first ``skip`` rows left out.

    To skip rows the keys must identify them: the first ones are found as a
    top list and taken out by key. An offset would move all rows to one task.
    """
    tie = as_list(tie)
    order = [col(column).desc_nulls_last(), *map(col, tie)]
    if skip:
        if not tie:
            raise ValueError("skipping needs a key that identifies the rows")
        first = df.orderBy(*order).limit(skip).select(*map(col, tie))
        first = F.broadcast(first) if skip <= BROADCAST_ROWS else first
        df = df.join(first, tie, "left_anti")
    return df.orderBy(*order)


def best_row(df: DataFrame, score: str, tie: str) -> DataFrame:
    """The row with the highest score; on equal scores the lowest ``tie``."""
    return df.orderBy(col(score).desc_nulls_last(), col(tie)).limit(1)


def attach_predictions(
    target: DataFrame, predictions: DataFrame, key: str, column: str, prediction: str = "prediction"
) -> DataFrame:
    """Overwrite a column with predictions, matched by key.

    Every target row stays once; one without a prediction gets NULL, and of
    several predictions for a key the largest counts.
    """
    require(target, [key, column])
    require(predictions, [key, prediction])
    scores = predictions.groupBy(col(key)).agg(F.max(col(prediction)).alias(column))
    return target.drop(column).join(scores, key, "left").select(*map(col, target.columns))
