"""Mixing sources to target weights by Pareto order sampling.

Sources share a number of words by weight; a source whose share would exceed
``most`` times its size stops there and its excess goes to the others. The
epochs of a source, target / size, are spent as whole copies of every document
(the certain part) and as a sample for the rest: documents are ordered by the
odds of a random number divided by the odds of inclusion, and the first ones
up to the wanted number of words are taken once more.

No source is sorted in one task: its random numbers fall into about as many
buckets as a bucket has rows, bucket sums find the bucket in which the sample
ends, and only that bucket is sorted, with equal rows counted as one entry. If
the sample ends among rows of one key and size, these are numbered over ranges
and the first of them are taken, so repeated or missing keys keep the target.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col
from .common import hex_number, numbered, saved, small, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SOURCES_BROADCAST = 50_000  # more sources are joined by a shuffle


def random_number(key: str, seed: int) -> Column:
    """Uniform in [0, 1), from the key alone: any rerun and partitioning agrees."""
    text = F.concat(F.coalesce(col(key).cast("string"), F.lit("")), F.lit(f"-{seed}"))
    return hex_number(F.substring(F.md5(text), 1, 13)) / F.lit(float(1 << 52))


def water_level(sources: DataFrame, words: float, most: float) -> float:
    """Level at which the sums of ``least(most * size, level * weight)`` reach the words.

    Each round is one aggregate over the sources; it ends when no further source is full.
    """
    weight = sources.agg(F.sum("weight")).first()[0]
    level = words / weight if weight else math.inf
    full = F.col("source_size") * F.lit(most)
    while True:
        stops = full <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(stops, full)).alias("full"), F.sum(F.when(~stops, F.col("weight"))).alias("free")
        ).first()
        if not row["free"]:
            return math.inf
        reached = (words - (row["full"] or 0.0)) / row["free"]
        if reached == level:
            return level
        level = reached


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``source, source_size, n, target`` from rows ``source, size``.

    Weights repeat over the sources in code-point order, a missing source last.
    """
    sums = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked = saved(
        numbered(sums, [F.col("source").asc_nulls_last()], "place").withColumn("weight", weight.cast("double")), "weights"
    )
    words = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(ranked, words, most)
    full = F.col("source_size") * F.lit(most)
    target = full if math.isinf(level) else F.least(full, F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", "n", target.alias("target"))


def _source_key(source: str) -> Column:
    """The source as a join key that is never missing."""
    return F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit(""))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan, their bucket and their odds ratio."""
    odds = lambda x: F.try_divide(x, 1 - x)
    return rows.join(plan, "__source").withColumns(
        {"__bucket": F.floor(F.col("__u") * F.col("__buckets")), "__rank": F.try_divide(odds(F.col("__u")), odds(F.col("__p")))}
    )


def _before_end(number: Column) -> Column:
    """Whether the middle of the so-manieth of equal rows lies before the wanted number of words."""
    return F.col("__begins") + number * F.col("size") - F.col("size") / 2 < F.col("__rest")


def sampling_plan(sized: DataFrame, key: str, targets: DataFrame) -> DataFrame:
    """Per source: whole copies, and where the sample of the rest ends.

    ``sized`` has ``__source, key, size, __u``. Within a source the order is by
    odds ratio, then key, then size. The sample ends at the last document whose
    middle lies before the wanted number of words: ``__cut``, with ``__begins``
    words before its equals, and ``__splits`` if not all of these are taken.
    """
    epochs = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    plan = targets.select(
        _source_key("source").alias("__source"),
        "source_size",
        "target",
        F.floor(epochs).alias("__whole"),
        (epochs - F.floor(epochs)).alias("__p"),
        (F.col("target") - F.floor(epochs) * F.col("source_size")).alias("__rest"),
        F.ceil(F.sqrt("n")).alias("__buckets"),
    )
    plan = saved(plan, "plan")
    rows = _with_plan(sized, small(plan.where("__p > 0"), SOURCES_BROADCAST))
    sums = rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("words"), F.max("__rest").alias("__rest"))
    upwards = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        sums.withColumn("__before", F.coalesce(F.sum("words").over(upwards), F.lit(0)))
        .where("__before < __rest AND __rest <= __before + words")
        .select("__source", "__bucket", "__before")
    )
    last = saved(last, "last")
    edge = rows.join(small(last, SOURCES_BROADCAST), ["__source", "__bucket"])
    place = ["__rank", key, "size"]
    equal = edge.groupBy("__source", "__before", "__rest", *place).agg(F.count("*").alias("__equal"))
    order = Window.partitionBy("__source").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    begins = F.col("__before") + F.coalesce(F.sum(F.col("size") * F.col("__equal")).over(order), F.lit(0))
    equal = equal.withColumn("__begins", begins)
    last_one = F.struct(F.struct(*place).alias("__cut"), "__begins", (~_before_end(F.col("__equal"))).alias("__splits"))
    cuts = equal.where(_before_end(F.lit(1))).groupBy("__source").agg(F.max(last_one).alias("__end")).select("__source", "__end.*")
    at = last.select("__source", F.col("__bucket").alias("__last")).join(cuts, "__source", "left")
    return saved(plan.join(at, "__source", "left"), "cuts")


def _sized(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return docs.select(
        col(source).alias("source"),
        _source_key(source).alias("__source"),
        col(key).alias(key),
        word_count(text).alias("size"),
        random_number(key, seed).alias("__u"),
        F.struct("*").alias("__doc"),
    )


def _decided(docs, weights, share, most, seed, key, text, source, narrow):
    """Documents with their plan and ``__copies``; the texts are not shuffled.

    ``narrow`` reads the documents once and keeps only key and size.
    """
    rows = _sized(docs, key, text, source, seed)
    sized = saved(rows.drop("__doc"), "sizes")
    targets = source_targets(sized.select("source", "size"), weights, share, most)
    plan = sampling_plan(sized, key, targets)
    rows = _with_plan(sized if narrow else rows, small(plan, SOURCES_BROADCAST))
    place = F.struct("__rank", key, "size")
    inside = (F.col("__bucket") == F.col("__last")) & (place <= F.col("__cut"))
    extra = (F.col("__p") > 0) & F.coalesce((F.col("__bucket") < F.col("__last")) | inside, F.lit(False))
    copies = lambda some, more: some.select(
        key, "size", "source_size", "target", *([] if narrow else ["__doc"]), (F.col("__whole") + more.cast("long")).alias("__copies")
    )
    if plan.where("__splits").isEmpty():
        return copies(rows, extra)
    open_ = F.coalesce(F.col("__splits") & (F.col("__bucket") == F.col("__last")) & place.eqNullSafe(F.col("__cut")), F.lit(False))
    like = F.lit(0) if narrow else F.xxhash64(F.col("__doc").getField(text))
    tied = saved(rows.where(open_).withColumns({"__like": like, "__row": F.monotonically_increasing_id()}), "tied")
    tied = numbered(tied, [F.col("__source"), F.col("__like"), F.col("__row")], "__place")
    first = saved(tied.groupBy("__source").agg(F.min("__place").alias("__first")), "first-of-tied")
    tied = tied.join(small(first, SOURCES_BROADCAST), "__source")
    return copies(rows.where(~open_), extra).unionByName(copies(tied, _before_end(F.col("__place") - F.col("__first") + 1)))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: ``key, size, source_size, target, taken``.

    ``taken`` is size times copies. A missing text has size 0, a missing source
    is a source of its own, and documents of size 0 are ordered like all others.
    """
    rows = _decided(docs, weights, share, most, seed, key, text, source, narrow=True)
    return rows.select(key, "size", "source_size", "target", (F.col("size") * F.col("__copies")).alias("taken"))


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The documents with all their columns, each as often as ``mix`` takes it."""
    rows = _decided(docs, weights, share, most, seed, key, text, source, narrow=False)
    return rows.select("__doc", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))).select("__doc.*")
