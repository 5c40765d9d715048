"""Feature bundles and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, numbers, require
from ..functions.encode import guarded_ratio, product
from ..plans.stats import one_row

# The derived insurance columns, name -> (operation, operands).
INSURANCE_FEATURES = {
    "Age_Vehicle_Age": ("product", "Age", "Vehicle_Age"),
    "Age_Previously_Insured": ("product", "Age", "Previously_Insured"),
    "Vehicle_Age_Damage": ("product", "Vehicle_Age", "Vehicle_Damage"),
    "Previously_Insured_Damage": ("product", "Previously_Insured", "Vehicle_Damage"),
    "Age_squared": ("square", "Age"),
    "Vehicle_Age_squared": ("square", "Vehicle_Age"),
    "Annual_Premium_per_Age": ("ratio", "Annual_Premium", "Age", 1),
}


def add_features(df: DataFrame, spec: Mapping[str, tuple]) -> DataFrame:
    """Products, squares and guarded ratios of columns, in one projection.

    ``{name: ("product", a, b) | ("square", a) | ("ratio", a, b, shift)}``;
    the ratio divides by ``b + shift`` and is NULL where that is zero.
    """
    made = {}
    for name, (how, *args) in spec.items():
        require(df, [a for a in args if isinstance(a, str)])
        if how == "product":
            made[name] = product(*args)
        elif how == "square":
            made[name] = product(args[0], args[0])
        elif how == "ratio":
            made[name] = guarded_ratio(*args)
        else:
            raise ValueError(f"unknown operation {how!r} for {name}")
    return df.withColumns(made)


def insurance_features(df: DataFrame) -> DataFrame:
    return add_features(df, INSURANCE_FEATURES)


def fit_scaler(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: mean and population deviation of each column, to be reused on other tables.

    A constant column has deviation 0 exactly, without rounding noise.
    """
    spread = lambda c: F.when(F.min(col(c)) == F.max(col(c)), F.lit(0.0)).otherwise(F.stddev_pop(col(c)))
    return df.agg(
        *[
            F.struct(F.avg(col(c)).alias("mean"), spread(c).alias("std")).alias(c)
            for c in numbers(df, columns)
        ]
    )


def apply_scaler(df: DataFrame, scaler: DataFrame, suffix: str = "") -> DataFrame:
    """``(x - mean) / std`` with a fitted scaler; a deviation of zero counts as 1."""
    s = one_row(scaler)
    return df.withColumns(
        {
            c + suffix: (col(c) - s.getField(c).getField("mean"))
            / F.when(s.getField(c).getField("std") == 0, F.lit(1.0)).otherwise(s.getField(c).getField("std"))
            for c in require(df, scaler.columns)
        }
    )


def standardize(df: DataFrame, columns: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
    columns = numbers(df, columns)
    return apply_scaler(df, fit_scaler(df, columns), suffix)


def features_and_label(
    df: DataFrame, label: str, features: Sequence[str] | None = None, keep: Sequence[str] = (),
    exclude: Sequence[str] = (), missing: str = "error",
) -> DataFrame:
    """``features`` vector and ``label`` double; a missing feature is an error, or NaN with ``missing="keep"``.

    By default all numeric columns except the label and the kept keys.
    """
    require(df, label)
    if features is None:
        features = numbers(df, None, exclude={label, *keep, *exclude})
    inputs = {f"__f{i}": col(c).cast("double") for i, c in enumerate(require(df, features))}
    table = df.select(
        *map(col, keep),
        *[value.alias(name) for name, value in inputs.items()],
        col(label).cast("double").alias("label"),
    )
    vectors = VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid=missing)
    return vectors.transform(table).select(*map(col, keep), "features", "label")
