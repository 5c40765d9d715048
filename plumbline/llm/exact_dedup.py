"""Exact duplicates by two passes over a counting Bloom filter.

The first pass writes one digest per row and counts, in a Bloom filter of
4-bit cells, how often the two cells of each digest are hit. The second pass
looks each row up: only rows whose cells were both hit twice may have an equal,
and only they are shuffled by their digest. All other rows pass through.

The filter is blocked: a word holds 15 cells, and both cells of a digest lie in
one word. A word that gets more than 15 rows counts as full, so a hot text can
only make the filter less selective, never lose a copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col
from .common import SPACE, concluded, saved, small

WORDS_PER_ROW = 2
CELLS = 15
TWICE = 0x0EEEEEEEEEEEEEEE  # the bits of all cells that are set from the second hit on
FILTER_ROWS = 500_000  # a filter of more words is joined by a shuffle of narrow rows


def text_digest(text: str) -> Column:
    """SHA-256 of the text without white space; a missing text counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(col(text), F.lit("")), f"[{SPACE}]+", ""), 256)


def _cell_columns(words: int) -> dict[str, Column]:
    first = F.pmod(F.shiftrightunsigned("__hash", 40), F.lit(CELLS))
    step = F.pmod(F.shiftrightunsigned("__hash", 8), F.lit(CELLS - 1)) + 1
    return {
        "__word": F.pmod(F.col("__hash"), F.lit(words)),
        "__bit1": (4 * first).cast("int"),
        "__bit2": (4 * F.pmod(first + step, F.lit(CELLS))).cast("int"),
    }


def _facts(key: str, text: str) -> list[Column]:
    chars = F.coalesce(F.char_length(col(text)), F.lit(0)).cast("long")
    return [col(key).alias("__id"), chars.alias("__chars"), text_digest(text).alias("__sha")]


def _staged(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), *_facts(key, text))
    return saved(rows.withColumn("__hash", F.xxhash64("__sha")), "digests")


def repeat_filter(staged: DataFrame) -> tuple[DataFrame, int]:
    """The words of the filter in which some cell was hit twice, and the number of all words."""
    words = max(64, WORDS_PER_ROW * staged.count())
    hits = F.expr("shiftleft(1L, __bit1) + shiftleft(1L, __bit2)")
    counted = (
        staged.select("__hash")
        .withColumns(_cell_columns(words))
        .groupBy("__word")
        .agg(F.try_sum(hits).alias("__cells"), F.count("*").alias("__rows"))
        .where("__rows > 1")
    )
    full = (F.col("__rows") > CELLS) | F.col("__cells").isNull()
    cells = F.when(full, F.lit(TWICE)).otherwise(F.col("__cells").bitwiseAND(F.lit(TWICE)))
    return counted.select("__word", cells.alias("__cells")).where("__cells <> 0"), words


def _marked(staged: DataFrame) -> DataFrame:
    """Adds ``__maybe``: whether an equal digest may exist."""
    found, words = repeat_filter(staged)
    found = small(saved(found, "filter"), FILTER_ROWS)
    hit = F.expr(
        "(shiftrightunsigned(__cells, __bit1) & 14L) <> 0 AND (shiftrightunsigned(__cells, __bit2) & 14L) <> 0"
    )
    return (
        staged.withColumns(_cell_columns(words))
        .join(found, "__word", "left")
        .withColumn("__maybe", F.coalesce(hit, F.lit(False)))
        .drop("__word", "__bit1", "__bit2", "__cells", "__hash")
    )


def _groups(maybe: DataFrame) -> DataFrame:
    best = F.min(F.struct(-F.col("__chars"), F.col("__id").isNull(), F.col("__id"), F.col("__row")))
    return maybe.groupBy("__sha").agg(F.count("*").alias("__size"), best.alias("__best"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical without white space; a missing text
    counts as empty. The row with the most code points stays, then the smallest
    key, a missing key last. Of rows that agree in that too, exactly one stays.
    """
    marked = _marked(_staged(docs, key, text))
    alone = marked.where("NOT __maybe").select(
        F.col("__id").alias(key),
        F.col("__id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )
    maybe = marked.where("__maybe").select("__sha", "__id", "__row", "__chars")
    groups = small(saved(_groups(maybe), "groups"), FILTER_ROWS)  # else a plain join, of which Spark splits hot keys
    found = maybe.select("__sha", "__id", "__row").join(groups, "__sha")
    return alone.unionByName(
        found.select(
            F.col("__id").alias(key),
            F.col("__best.__id").alias("keep_id"),
            F.col("__size").alias("group_size"),
            (F.col("__row") == F.col("__best.__row")).alias("kept"),
            F.col("__sha").alias("text_sha256"),
        )
    )


def _repeated(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per text that repeats: the digest, length and key of the rows that may stay, and how many these are."""
    maybe = _marked(_staged(docs, key, text)).where("__maybe")
    equal = maybe.groupBy("__sha", "__chars", "__id").agg(F.count("*").alias("n"))
    best = F.min(F.struct(-F.col("__chars"), F.col("__id").isNull(), F.col("__id"), "n")).alias("best")
    groups = equal.groupBy("__sha").agg(F.sum("n").alias("size"), best).where("size > 1")
    return groups.select("__sha", (-F.col("best.col1")).alias("__most"), F.col("best.__id").alias("__least"), F.col("best.n").alias("__equal"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that ``exact_groups`` keeps, with all their columns.

    The texts are read twice and not written: once for their digests, and once to leave out
    the rows that go. Only digests that may repeat are shuffled, and the rows of a
    text whose best row repeats; beyond ``FILTER_ROWS`` repeated texts the rows meet their groups by a
    plain join. An empty table stays empty. Columns may have any names, those used here included, and come back as they were.
    """
    groups = small(concluded("repeated", _repeated, docs, key, text), FILTER_ROWS)
    found = docs.select(F.struct("*").alias("__whole"), *_facts(key, text)).join(groups, "__sha", "left")
    best = (F.col("__chars") == F.col("__most")) & F.col("__id").eqNullSafe(F.col("__least"))
    alone = found.where(F.col("__equal").isNull() | (best & (F.col("__equal") == 1))).select("__whole.*")
    if groups.where("__equal > 1").isEmpty():
        return alone
    return alone.unionAll(found.where(best & (F.col("__equal") > 1)).dropDuplicates(["__sha"]).select("__whole.*"))
