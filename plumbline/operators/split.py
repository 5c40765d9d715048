"""Reproducible splits and folds from a row key."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import col, require
from ..functions.hashing import below, digest, fold_number, key_text
from ..plans.order_stats import ROWS_PER_TASK, quantiles
from ..plans.running import ROWS_PER_SORT
from ..plans.stats import checked_broadcast
from ..plans.storage import cut_lineage


def _drawn_by(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Adds ``__draw_by``: the key as text, or for a row without any key the text of all its columns."""
    keys = require(df, key)
    missing = reduce(lambda a, b: a & b, [col(k).isNull() for k in keys])
    row = F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("NULL")) for c in df.columns])
    return df.withColumn("__draw_by", F.when(missing, row).otherwise(key_text(keys)))


def mark_split(
    df: DataFrame, key: str | Sequence[str], test_size: float = 0.2, seed: int = 42, marker: str = "is_test"
) -> DataFrame:
    """True for the test rows: a hash of the key, in expectation ``test_size`` of them.

    Rows without a key are drawn by all their columns, so only equal ones share a draw.
    """
    return _drawn_by(df, key).withColumn(marker, below("__draw_by", test_size, seed)).drop("__draw_by")


def train_test_split(
    df: DataFrame, key: str | Sequence[str], test_size: float = 0.2, seed: int = 42, exact: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, DataFrame]:
    """Train and test table; every row is in exactly one of them.

    ``exact=True`` puts exactly ``ceil(test_size * rows)`` rows in the test
    table: those up to that rank by the hash of the key. Where rows of one hash stand at the cut, as
    repeats of a key do, as many of them as are wanted are taken one by one.
    """
    require(df, key)
    if not exact:
        marked = mark_split(df, key, test_size, seed, "__test")
        return (
            marked.where(~F.col("__test")).drop("__test"),
            marked.where(F.col("__test")).drop("__test"),
        )
    n = df.count()
    size = math.ceil(test_size * n)
    by = "__draw_by"
    place = F.conv(F.concat(digest(by, seed), F.substring(digest(by, f"more-{seed}"), 1, 4)), 16, 10).cast("double")
    marked = _drawn_by(df, key).withColumn("__place", place).drop(by)
    if size == 0 or size >= n:
        test = F.lit(size > 0)
        return marked.where(~test).drop("__place"), marked.where(test).drop("__place")
    # a rounded probability may lie a hair beside the rank: the cut is the least hash from there on, which is whole
    cut = quantiles(marked, "__place", [(size - 1) / (n - 1)], rows_per_task=rows_per_task).first()["quantiles"][0]
    cut = marked.where(F.col("__place") >= math.floor(cut + 1e-3) - 0.5).agg(F.min("__place")).first()[0]
    found = marked.agg(F.count_if(F.col("__place") < cut).alias("below"), F.count_if(F.col("__place") == cut).alias("at")).first()
    wanted = size - found["below"]
    if wanted == found["at"]:
        test = F.col("__place") <= cut
        return marked.where(~test).drop("__place"), marked.where(test).drop("__place")
    # rows of one hash: numbered inside their partitions, and on from one partition to the next
    marked = cut_lineage(marked.withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()}))
    ties = marked.where(F.col("__place") == cut)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = ties.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    number = F.row_number().over(Window.partitionBy("__part").orderBy("__id")) + F.col("__start")
    taken = ties.join(checked_broadcast(starts), "__part").where(F.col("__start") < wanted)
    taken = taken.withColumn("__number", number).where(F.col("__number") <= wanted).select("__id", F.lit(True).alias("__taken"))
    marked = marked.join(taken, "__id", "left")
    test = (F.col("__place") < cut) | F.col("__taken").isNotNull()
    extra = ["__place", "__part", "__id", "__taken"]
    return marked.where(~test).drop(*extra), marked.where(test).drop(*extra)


def add_folds(
    df: DataFrame, key: str | Sequence[str], folds: int = 5, seed: int = 42, fold: str = "fold"
) -> DataFrame:
    """Fold 0 .. folds-1 of each row from a hash of its key; rows without a key by all their columns."""
    return _drawn_by(df, key).withColumn(fold, fold_number("__draw_by", folds, seed)).drop("__draw_by")


def add_stratified_folds(
    df: DataFrame, key: str, label: str, folds: int = 5, fold: str = "fold", rows_per_task: int = ROWS_PER_SORT
) -> DataFrame:
    """Folds whose counts per label differ by at most one row.

    The rows of a label are numbered and dealt out in turn. A label may hold
    most of the table, so its rows are numbered within hash buckets of the
    key, and each bucket goes on where the buckets before it end.
    """
    require(df, [key, label])
    buckets = max(1, math.ceil(df.count() / rows_per_task))
    placed = df.withColumn("__bucket", F.pmod(F.xxhash64(col(key)), F.lit(buckets)))
    inside = Window.partitionBy(col(label), "__bucket").orderBy(col(key))
    numbered = placed.withColumn("__number", F.row_number().over(inside) - 1)
    # at most `buckets` rows per label
    earlier = Window.partitionBy("__label").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(col(label).alias("__label"), F.col("__bucket").alias("__at"))
        .count()
        .withColumn("__start", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .drop("count")
    )
    same = (F.col("__bucket") == F.col("__at")) & col(label).eqNullSafe(F.col("__label"))
    number = ((F.col("__number") + F.col("__start")) % folds).cast("int")
    return (
        numbered.join(starts, same)
        .withColumn(fold, number)
        .drop("__bucket", "__number", "__label", "__at", "__start")
    )
