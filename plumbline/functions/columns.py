"""Names, types and schema checks shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> str:
    """Back-quote a column name, so spaces, brackets and dots are plain text."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def as_list(names: str | Iterable[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def require(df: DataFrame, names: str | Iterable[str]) -> list[str]:
    """The names as a list; raises if the table lacks one of them."""
    names = as_list(names)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not in the table: {missing}; it has {df.columns}")
    return names


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def numbers(df: DataFrame, columns: Sequence[str] | None, exclude: Iterable[str] = ()) -> list[str]:
    """The given columns, or all numeric ones."""
    if columns is None:
        return numeric_columns(df, exclude)
    skip = set(exclude)
    return [c for c in require(df, columns) if c not in skip]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace floating NaN by NULL, so that aggregates skip it.

    Spark orders NaN above every number and lets it poison ``avg``; NULL is
    the only missing value the operators know.
    """
    fixes = {
        f.name: F.when(~F.isnan(col(f.name)), col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixes) if fixes else df
