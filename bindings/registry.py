"""Registration of queries and the helpers their definitions share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.columns import col
from plumbline.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded, since engines add them up in different orders."""
    return df.select(
        *[
            F.round(col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else col(f.name)
            for f in df.schema.fields
        ]
    )


def union(branches) -> str:
    return "\nUNION ALL\n".join(branches)


def hits(column: str, value: str) -> str:
    return f"CAST({column} = '{value}' AS INTEGER)"


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def holey(t: Tables) -> DataFrame:
    """lineitem with missing values: no driver table has any."""
    return t.lineitem.select(
        "l_orderkey",
        "l_quantity",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"),
    )


HOLEY = """(SELECT l_orderkey, l_quantity, nullif(l_discount, 0.0) AS l_discount,
       nullif(l_tax, 0.0) AS l_tax, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem)"""
HOLEY_COLUMNS = ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
