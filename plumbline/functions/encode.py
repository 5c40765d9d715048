"""Encodings and row arithmetic, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .columns import col, require


def mapped(value: Column, mapping: Mapping, otherwise: Column | None = None) -> Column:
    """CASE over a value map; a value outside the map becomes NULL or ``otherwise``."""
    out = None
    for key, new in mapping.items():
        hit = value == F.lit(key)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    if out is None:
        return F.lit(None) if otherwise is None else otherwise
    return out if otherwise is None else out.otherwise(otherwise)


def map_values(df: DataFrame, column: str, mapping: Mapping, into: str | None = None) -> DataFrame:
    """Value map, NULL on a miss (also serves ordinal encodings)."""
    require(df, column)
    return df.withColumn(into or column, mapped(col(column), mapping))


def replace_values(
    df: DataFrame, column: str, mapping: Mapping, into: str | None = None, strict: bool = False
) -> DataFrame:
    """Value map that passes unmapped values through.

    A Spark column has one type. With values of another type in the map the
    result is text, since an unmapped value keeps its text. ``strict=True``
    states that every value is mapped: the result has the map's type and an
    unmapped value fails the query.
    """
    require(df, column)
    kind = df.schema[column].dataType
    source = col(column)
    same = all(isinstance(v, str) for v in mapping.values()) and isinstance(kind, T.StringType)
    if strict:
        miss = F.raise_error(
            F.concat(F.lit(f"value of {column} is not in the map: "), source.cast("string"))
        )
        out = F.when(source.isNotNull(), mapped(source, mapping, miss))
    elif same:
        out = mapped(source, mapping, source)
    elif isinstance(kind, T.NumericType) and all(
        isinstance(v, (int, float)) and not isinstance(v, bool) for v in mapping.values()
    ):
        out = mapped(source, mapping, source)
    else:
        texts = {k: str(v) for k, v in mapping.items()}
        out = mapped(source, texts, source.cast("string"))
    return df.withColumn(into or column, out)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number padded with zeros to ``width``, never cut."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def product(a: str, b: str) -> Column:
    """Product of two columns in double, so that integers cannot overflow."""
    return col(a).cast("double") * col(b).cast("double")


def guarded_ratio(a: str, b: str, shift: float = 0) -> Column:
    """``a / (b + shift)``, NULL where the divisor is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double") + F.lit(float(shift)))
