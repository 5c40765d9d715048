"""Delimited text in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import col, nan_to_null

# Fields that data scientists' readers take as missing.
MARKERS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    row_key: str | None = None,
    sep: str = ",",
    multi_line: bool = False,
    missing: Sequence[str] = (),
) -> DataFrame:
    """A comma-separated file with a header line; an empty field is NULL.

    Fields that are one of the ``missing`` markers, such as ``MARKERS``, are NULL as well. Then a column without a schema gets the
    narrowest type that holds all its other fields (``narrowest_types``), and a field that does not fit a
    given type is NULL.

    A quote inside a quoted field is doubled. ``multi_line`` allows line breaks
    inside quoted fields; a file can then not be split among tasks.

    Give a schema for large inputs: without one Spark reads the file twice.
    ``row_key`` adds a column that sorts rows in file order, which Spark does
    not keep by itself.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    reader = reader.option("escape", '"').option("multiLine", multi_line)
    if missing:
        types = _parsed(spark, schema)
        if types is not None:  # names come from the schema, values are read as text first
            reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in types]))
        df = _without_markers(reader.csv(path), missing)
    else:
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        df = reader.csv(path)
    if row_key:
        place = F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("row"),
        )
        df = df.select("*", place.alias(row_key))
    if missing:
        texts = [c for c in df.columns if c != row_key]
        wanted = {f.name: f.dataType.simpleString() for f in types} if types is not None else narrowest_types(df.select(*map(col, texts)))
        df = df.withColumns({c: col(c).try_cast(t) for c, t in wanted.items() if t != "string"})
    return nan_to_null(df)


def _parsed(spark: SparkSession, schema: T.StructType | str | None) -> T.StructType | None:
    return spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema


def _without_markers(df: DataFrame, missing: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.trim(col(c)).isin(list(missing)), col(c)) for c in df.columns})


def narrowest_types(texts: DataFrame) -> dict[str, str]:
    """The narrowest of int, bigint, double, boolean and string for each text column, in one aggregate.

    Missing fields fit every type; a column without other fields stays a string.
    """
    fits = {}
    for i, c in enumerate(texts.columns):
        whole = col(c).rlike(r"^\s*[+-]?\d+\s*$")
        tests = [whole & col(c).try_cast("int").isNotNull(), whole & col(c).try_cast("bigint").isNotNull()]
        tests += [col(c).try_cast("double").isNotNull(), F.lower(F.trim(col(c))).isin("true", "false")]
        fits |= {f"{i}_{k}": F.bool_and(F.when(col(c).isNotNull(), test)) for k, test in enumerate(tests)}
    found = texts.agg(*[test.alias(name) for name, test in fits.items()]).first()
    first = lambda i: next((t for k, t in enumerate(("int", "bigint", "double", "boolean")) if found[f"{i}_{k}"]), "string")
    return {c: first(i) for i, c in enumerate(texts.columns)}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A directory of CSV parts, each with a header, without an index column.

    Text is kept as it is: Spark would trim blanks at its ends.
    """
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)
    return path


def csv_roundtrip(df: DataFrame, path: str, multi_line: bool = False) -> DataFrame:
    """Write the table as CSV and read it back with the same schema."""
    write_csv(df, path)
    return read_csv(df.sparkSession, path, schema=df.schema, multi_line=multi_line)
