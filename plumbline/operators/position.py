"""File order as the identity of rows that have no key.

A row's position is the number of rows before it: files in the order of their
paths, blocks in the order of their start, rows as they stand in the block. It comes from the
scan's own metadata. Only the blocks are counted and summed up, one row each; the rows are neither sorted nor
shuffled. A table that is scanned twice with the same settings has the same positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import col, require
from ..plans.stats import checked_broadcast


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Adds the place of each row in the files, from 0; ``df`` is read from files, not joined or grouped."""
    rows = df.select(
        F.struct("*").alias("__row"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"),
    )
    blocks = rows.groupBy("__file", "__block").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    # one row per block of a file
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("__file", "__block", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    placed = rows.join(checked_broadcast(starts), ["__file", "__block"])
    return placed.select("__row.*", (F.col("__id") - F.col("__first") + F.col("__start")).alias(name))


def head_in_file(df: DataFrame, n: int = 5, name: str = "position") -> DataFrame:
    """The first rows of the files with their positions."""
    return with_position(df, name).where(col(name) < n)


def tail_in_file(df: DataFrame, n: int = 5, name: str = "position") -> DataFrame:
    """The last rows of the files with their positions."""
    placed = with_position(df, name)
    return placed.where(col(name) >= F.lit(df.count() - n))


def keep_first_in_file(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The first row of each combination in file order; missing values are equal."""
    columns = require(df, columns or df.columns)
    placed = with_position(df, "__position")
    rows = placed.select(F.struct(*map(col, df.columns)).alias("__row"), *[col(c).alias(f"__k{i}") for i, c in enumerate(columns)], "__position")
    first = rows.groupBy(*[f"__k{i}" for i in range(len(columns))]).agg(F.min_by("__row", "__position").alias("__row"))
    return first.select("__row.*")


def attach_by_position(sheet: DataFrame, values: DataFrame, value: str, name: str) -> DataFrame:
    """The sheet with ``value`` of the row at the same place of another table of the same length, as ``name``.

    Tables of different length are an error. A column of the sheet with that name is replaced.
    """
    require(values, value)
    if sheet.count() != values.count():
        raise ValueError("the tables differ in length")
    kept = [c for c in sheet.columns if c != name]
    rows = with_position(sheet.select(*map(col, kept)), "__position")
    found = with_position(values.select(col(value).alias("__value")), "__position")
    return rows.join(found, "__position").select(*map(col, kept), F.col("__value").alias(name))
