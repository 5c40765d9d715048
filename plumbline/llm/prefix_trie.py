"""The trie of conversation prefixes, screened by a count-min sketch.

The digest of a prefix is the exclusive or of one 128-bit digest per turn, each made
of the turn's place, role and text. So digests are added up inside ranges of
rows and the ranges put together, however long one conversation is, and the digest of
the parent is the prefix's without that of its last turn.

A count-min sketch counts all prefixes in two rows of cells; both cells of a
prefix lie in one 64-bit word. The lesser of its two counts is never below the true
one: an estimate of one proves that a single conversation has the prefix. Such
tails are emitted where they are. Only the other prefixes are shuffled and grouped exactly.

A node is named by its smallest member, so the nodes of one name form a chain downwards.
Sums over subtrees are sums over the members of a node of what their chains hold, less
the part of the node's own chain that lies above it. No step walks down the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col
from .common import WORD, saved, small

GROUP = 20  # conversations that share the first turns of one of them
SHARED = 4  # one more than the most turns that are shared
PREFIXES_PER_WORD = 4  # of the sketch
BROADCAST = 500_000
CHUNK = 1 << 20  # characters of a list of conversations that are handed on as one row
KEY = ["depth", "hi", "lo"]


def running(rows: DataFrame, by: str, order: str, counts: Mapping[str, Column], xors: Mapping[str, Column]) -> DataFrame:
    """Adds running sums and running exclusive ors of each ``by``, this row included, in the order of ``order``.

    Ranges of rows are added up apart and shifted by what precedes them; a group
    may be spread over many ranges. Only groups at the edge of a range are shifted,
    at most one per range.
    """
    made = {**counts, **xors}
    ranged = saved(rows.withColumns(made).repartitionByRange(by, order).withColumn("part", F.spark_partition_id()), "ranges")
    both = [(n, F.sum, lambda x, y: x + y) for n in counts] + [(n, F.bit_xor, lambda x, y: x.bitwiseXOR(y)) for n in xors]
    edges = ranged.groupBy("part").agg(F.max(by).alias(by)).select(by).distinct()  # one row per range
    inside = ranged.join(F.broadcast(edges), by, "left_semi").groupBy(by, "part").agg(*[f(n).alias(n) for n, f, _ in both])
    above = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = inside.select(by, "part", *[F.coalesce(f(n).over(above), F.lit(0)).cast("long").alias(f"{n}_above") for n, f, _ in both])
    here = Window.partitionBy("part", by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({n: f(n).over(here) for n, f, _ in both}).join(F.broadcast(shifts), [by, "part"], "left")
    added = {n: add(F.col(n), F.coalesce(f"{n}_above", F.lit(0).cast("long"))).cast("long") for n, _, add in both}
    return summed.withColumns(added).drop("part", *[f"{n}_above" for n, _, _ in both])


def _turns(talks: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, pos, content, words``: every turn with its place in its conversation and a digest of role and text."""
    who, said = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = talks.where(col(key).isNotNull()).select(
        col(key).cast("long").alias("conv"), col(turn).alias("turn"), who.alias("role"), said.alias("text")
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    content = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    narrow = placed.select(
        "conv", F.monotonically_increasing_id().alias("seq"), content.alias("content"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    return running(saved(narrow, "turns"), "conv", "seq", {"pos": F.lit(1).cast("long")}, {})


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations ``conv, total`` and their rebuilt turns ``conv, depth, content, words``."""
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    sizes = sizes.withColumn("shared", F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(SHARED)))
    sizes = saved(sizes.withColumn("base", F.col("conv") - F.col("conv") % GROUP), "sizes")
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("offered"))
    talks = sizes.join(bases, "base", "left").withColumn("taken", F.least("shared", F.coalesce("offered", F.lit(0))))
    talks = talks.withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0)))
    talks = small(saved(talks.select("conv", "base", "shared", "taken", "total"), "talks"), BROADCAST)
    kept = turns.join(talks.select("conv", "shared", "taken"), "conv").where("pos > shared")
    kept = kept.select("conv", (F.col("taken") + F.col("pos") - F.col("shared")).alias("depth"), "content", "words")
    first = turns.where(F.col("pos") < SHARED).withColumnRenamed("conv", "base")
    lent = first.join(talks.select("conv", "base", "taken"), "base").where("pos <= taken")
    lent = lent.select("conv", F.col("pos").alias("depth"), "content", "words")
    return talks.select("conv", "total"), kept.unionByName(lent)


def _prefixes(talks: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv``, the prefix ``depth, hi, lo``, its parent's ``phi, plo``, ``words`` of its last turn and ``last``; with the root."""
    digest = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("content")))
    half = lambda start: F.conv(F.substring("digest", start, 16), 16, -10).cast("long")
    rows = turns.withColumn("digest", digest).select("conv", "depth", "words", half(1).alias("own_hi"), half(17).alias("own_lo"))
    made = running(rows, "conv", "depth", {}, {"hi": F.col("own_hi"), "lo": F.col("own_lo")})
    made = made.join(talks, "conv").select(
        "conv", *KEY, F.col("hi").bitwiseXOR(F.col("own_hi")).alias("phi"), F.col("lo").bitwiseXOR(F.col("own_lo")).alias("plo"),
        "words", (F.col("depth") == F.col("total")).alias("last"),
    )
    none = F.lit(0).cast("long")
    root = talks.select("conv", *[none.alias(c) for c in (*KEY, "phi", "plo", "words")], (F.col("total") == 0).alias("last"))
    return saved(made.unionByName(root), "prefixes")


def _cells(hi: str, lo: str, words: int) -> list[Column]:
    """The word of a prefix and its cell in either row of the sketch."""
    low = F.col(lo)
    return [
        F.pmod(F.col(hi), F.lit(words)), F.pmod(low, F.lit(32)).cast("int"),
        (F.pmod(F.shiftright(low, 5), F.lit(32)) + 32).cast("int"),
    ]


def sketch(prefixes: DataFrame) -> tuple[DataFrame, int]:
    """``word, cells``: which cells were hit more than once, and the number of words, which grows with the prefixes."""
    words = max(64, prefixes.count() // PREFIXES_PER_WORD)
    word, first, second = _cells("hi", "lo", words)
    hits = prefixes.select(word.alias("word"), F.explode(F.array(first, second)).alias("cell")).groupBy("word", "cell").count()
    often = hits.where("count > 1").groupBy("word").agg(F.expr("bit_or(shiftleft(1L, cell))").alias("cells"))
    return saved(often, "sketch"), words


def _screened(prefixes: DataFrame) -> DataFrame:
    """Adds ``many`` and ``parent_many``: whether the estimates of the prefix and its parent are above one."""
    often, words = sketch(prefixes)
    often = small(often, BROADCAST)
    for name, hi, lo in (("many", "hi", "lo"), ("parent_many", "phi", "plo")):
        word, first, second = _cells(hi, lo, words)
        marked = prefixes.withColumns({"word": word, "x": first, "y": second}).join(often, "word", "left")
        above = F.expr("(shiftrightunsigned(cells, x) & shiftrightunsigned(cells, y) & 1L) = 1")
        prefixes = marked.withColumn(name, F.coalesce(above, F.lit(False))).drop("word", "x", "y", "cells")
    return saved(prefixes, "screened")


def _end_digests(ends: DataFrame) -> DataFrame:
    """``depth, hi, lo, ends``: SHA-256 of the conversations that end in a node, in order, joined by commas.

    Lists are written in pieces by many tasks and hashed piece by piece, so none is ever held whole.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows):
            names = [*KEY, "first", "piece"]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]), pa.array([r[4] for r in rows])], names)

        now, first, held, size = None, None, [], 0
        for batch in batches:
            out = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv"))):
                if key != now or size > CHUNK:
                    if held:
                        out.append((*now, first, ",".join(held)))
                    now, first, held, size = key, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield made(out)
        if held:
            yield made([(*now, first, ",".join(held))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows):
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:3]), pa.array([r[3] for r in rows])], [*KEY, "ends"])

        now, state = None, None
        for batch in batches:
            out = []
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece"))):
                if key != now:
                    if state is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            if out:
                yield made(out)
        if state is not None:
            yield made([(*now, state.hexdigest())])

    key = ", ".join(f"{c} long" for c in KEY)
    spread = ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    parts = saved(spread.mapInArrow(pieces, f"{key}, first long, piece string"), "ends")
    return parts.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, f"{key}, ends string")


def _chains(nodes: DataFrame) -> DataFrame:
    """Adds ``above``: what the nodes of the same name above each node save."""
    summed = running(nodes, "rep", "depth", {"upto": F.col("gain")}, {})
    return summed.withColumn("above", F.col("upto") - F.col("gain")).drop("upto")


def prefix_trie(talks: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by number, a missing one first; turns of one number by role, then text, so that
    repeated rows are turns of their own. A missing role or text is empty. Rows without a
    conversation are left out. A conversation that is rebuilt without turns ends in the root;
    an empty table has no nodes. Texts of any length are digested whole. Other columns are not read.
    """
    conversations, turns = _rebuilt(_turns(talks, key, turn, role, text))
    screened = _screened(_prefixes(conversations, turns))
    shared, tails = screened.where("many"), screened.where("NOT many")

    parent = [F.col("depth") - 1, F.col("phi"), F.col("plo")]
    nodes = shared.groupBy(*KEY).agg(
        F.count("*").alias("n"), F.min("conv").alias("rep"), F.max("phi").alias("phi"), F.max("plo").alias("plo"),
        ((F.count("*") - 1) * F.max("words")).alias("gain"),
    )
    nodes = saved(nodes, "nodes")
    below = nodes.select(*[p.alias(c) for p, c in zip(parent, KEY)]).unionByName(
        tails.where("parent_many").select(*[p.alias(c) for p, c in zip(parent, KEY)])
    )
    children = below.groupBy(*KEY).agg(F.count("*").alias("children"))
    nodes = nodes.join(children, KEY, "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long")))
    nodes = saved(_chains(nodes), "chains")

    leaf = lambda c: c.cast("long").alias("leaves")
    held = nodes.select(F.col("rep").alias("conv"), "gain", leaf(F.col("children") == 0)).unionByName(
        tails.where("last").select("conv", F.lit(0).cast("long").alias("gain"), leaf(F.lit(1)))
    )
    held = held.groupBy("conv").agg(F.sum("gain").alias("gain"), F.sum("leaves").alias("leaves"))
    held = small(saved(held, "held"), BROADCAST)
    sums = shared.select("conv", *KEY).join(held, "conv", "left").groupBy(*KEY).agg(
        F.coalesce(F.sum("gain"), F.lit(0)).alias("under"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves")
    )
    names = small(saved(nodes.select(*KEY, F.col("rep").alias("parent")), "names"), BROADCAST)
    above = names.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("phi"), F.col("lo").alias("plo"), "parent")
    nothing = F.sha2(F.lit(""), 256)
    grouped = (
        nodes.join(sums, KEY)
        .join(_end_digests(shared.where("last")), KEY, "left")
        .join(above, ["depth", "phi", "plo"], "left")
        .select(
            F.col("rep").alias("conv_id"), "depth",
            F.when(F.col("depth") > 0, F.coalesce("parent", "rep")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
            (F.col("under") - F.col("above")).alias("saved_tokens"), F.coalesce("ends", nothing).alias("ends_sha256"),
        )
    )
    one = F.lit(1).cast("long")

    def alone(rows: DataFrame, parent_conv: Column) -> DataFrame:
        return rows.select(
            F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, parent_conv).alias("parent_conv_id"),
            one.alias("n_convs"), F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
        )

    inner = alone(tails.where("NOT parent_many"), F.col("conv"))
    first = alone(tails.where("parent_many").join(above, ["depth", "phi", "plo"], "left"), F.coalesce("parent", "conv"))
    return grouped.unionByName(inner).unionByName(first)
