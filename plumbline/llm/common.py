"""Written intermediate tables, global numbering and other shared steps."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import col
from ..plans.storage import fresh_path, release, remove_folder

SPACE = r"\x20\x09-\x0D"  # the characters that separate words, inside a character class
WORD = rf"[^{SPACE}]+"
BATCHES = {  # the most that is handed to Python at once while a table is written: rows, and bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": 500,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
}


def _number(setting: str) -> int:
    """A setting such as 500, 64m or 67108864b."""
    digits, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(digits) << (10 * " kmgtp".index(unit or " "))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Small Arrow batches for what is planned inside: whole texts and sets make wide rows.

    A smaller setting of the session stays, and afterwards the session is as it was.
    """
    before = {name: spark.conf.get(name) for name in BATCHES}
    for name, most in BATCHES.items():
        now = _number(before[name])
        spark.conf.set(name, most if now <= 0 else min(most, now))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


_written: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("_written", default=None)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables saved inside are deleted at the end, also after an error."""
    made: list[tuple[SparkSession, str]] = []
    token = _written.set(made)
    try:
        yield
    finally:
        _written.reset(token)
        for spark, path in made:
            remove_folder(spark, path)


def saved(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read again.

    Cuts the lineage: a lost executor never causes earlier steps to run again,
    and row numbers or partition numbers in it are fixed from here on. The table
    lasts until the ``scratch`` around it ends.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    made = _written.get()
    if made is not None:
        made.append((spark, path))
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def concluded(label: str, step: Callable[..., DataFrame], *args) -> DataFrame:
    """The result of a step, saved; the tables the step saved on its way are deleted, and what it broadcast is freed."""
    outer = _written.get()
    with scratch():
        out = step(*args)
        inner = _written.set(outer)  # the result outlasts the step
        try:
            table = saved(out, label)
        finally:
            _written.reset(inner)
    del out
    release(table.sparkSession)
    return table


def small(df: DataFrame, most: int) -> DataFrame:
    """A saved table, marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.count() <= most else df


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the place of each row in the order, from 0, without sorting all rows in one task.

    Ranges of the order are sorted apart, and shifted by the rows before them.
    """
    ranged = saved(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ordered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__part").count().select(
        "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start")
    )  # one row per partition
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return (
        ranged.withColumn(name, place.cast("long"))
        .join(F.broadcast(starts), "__part")
        .withColumn(name, F.col(name) + F.col("__start"))
        .drop("__part", "__start")
    )


def hex_number(digits: Column) -> Column:
    """Up to 15 hexadecimal digits as a long."""
    return F.conv(digits, 16, 10).cast("long")


def word_count(text: str) -> Column:
    """Number of words of a text column; a missing text has none."""
    return F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("long")


def drawn(n: Column, key: str, salt: str, share: float) -> Column:
    """How many of ``n`` equal rows a sample of a share takes: their share, rounded up or down by a hash of the key.

    The expectation is the share of all rows, however often some of them repeat.
    """
    u = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(n * F.lit(float(min(1.0, share))) + u).cast("long")
