"""Tables: from rows, from Parquet, to a catalog, a folder or a database."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame, SparkSession, types as T


def table_from_rows(spark: SparkSession, rows: Iterable[Sequence], names: Sequence[str] | T.StructType) -> DataFrame:
    """A small table from rows and column names."""
    return spark.createDataFrame(list(rows), names)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def replace_table(df: DataFrame, name: str) -> None:
    """Drop and recreate a catalog table with the rows; no index column is added."""
    df.write.mode("overwrite").saveAsTable(name)


def replace_folder(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def replace_database_table(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Drop and recreate a database table over JDBC.

    Driver class, user and password come in as options; each partition writes
    over its own connection, so repartition to what the database can take.
    """
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("overwrite").save()


def save_model(model, path: str) -> str:
    """Write a fitted model, replacing an older one."""
    model.write().overwrite().save(path)
    return path


def load_model(kind: type[MLReadable], path: str):
    return kind.load(path)
