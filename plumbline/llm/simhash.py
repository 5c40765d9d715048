"""SimHash near-duplicates by covering the space of fingerprints with anchor points.

Anchors are the words of a perfect binary code of 23 bits (radius 3, 4,096 words), taken
twice: once for the lowest 23 bits of a fingerprint and once for the next 23. Each
fingerprint lies within the covering radius of exactly one anchor of either half,
its home. If two fingerprints differ in at most ``most`` bits, the home of one lies
within the radius plus the differing bits of the other, half by half. So every
fingerprint is replicated to all anchors that near, and compared per anchor with those at home there.

An anchor that more than ``crowd`` fingerprints reach is not compared pairwise. Its
fingerprints are covered again by the finest code, where every point is an anchor:
two of them differ in at most two bits if and only if they share a point at most
one bit away from both. At most 65 fingerprints meet in such a point, however many copies
a group has, and all that meet are linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col
from .arrays import slices
from .bitmaps import bitmap, contains
from .common import saved, small
from .components import components

SHINGLE = 3
MOST = 2  # differing bits of linked fingerprints
SEED = 42
CHUNK = 1 << 20  # bytes of one text that are split at once
CROWD = 512  # fingerprints at an anchor from which it is covered again

# Fixed values of the code: its length, radius, check bits and generator polynomial
LENGTH, RADIUS, CHECKS = 23, 3, 11
GENERATOR = 0b110001110101

BROADCAST = 500_000

BLOCKS = 2
ANCHOR_BITS = BLOCKS * (LENGTH - CHECKS)  # an anchor is numbered by the message bits of its words
MASK = (1 << LENGTH) - 1


# ---- fingerprints

def shingle_hashes(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of a text, repeats included, in arrays that are not too long.

    Words are joined by one space; a text of fewer words is one shingle, one without words has none.
    """
    held: list[bytes] = []
    start, found = 0, False
    while start < len(text):
        stop = start + CHUNK
        stop = len(text) if stop >= len(text) else text.find(b" ", stop)
        stop = len(text) if stop < 0 else stop
        words = held + text[start:stop].lower().split()
        start = stop
        if len(words) >= size:
            joined = memoryview(b" ".join(words))
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            begin = np.cumsum(lengths + 1) - lengths - 1
            end = (begin + lengths)[size - 1 :]
            yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist())], np.uint64)
            found, words = True, words[len(words) - size + 1 :] if size > 1 else []
        held = words
    if held and not found:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' hashes; 0 without shingles."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        for at in range(0, len(hashes), 1 << 16):
            some = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8)
            ones += np.unpackbits(some).reshape(-1, 64).sum(0, dtype=np.int64)
        n += len(hashes)
    return int("".join("1" if 2 * k > n else "0" for k in ones), 2)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``id, print``: the fingerprint of every row as a signed 64-bit number; a missing text has none of its bits set."""
    rows = docs.select(col(key).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = [fingerprint(t.as_buffer().to_pybytes(), size) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.array(made, np.uint64).view(np.int64))], ["id", "print"])

    return rows.mapInArrow(find, f"id {rows.schema['id'].dataType.simpleString()}, print long")


# ---- the covering code

def _remainder(words: np.ndarray) -> np.ndarray:
    """Check bits of words of the code's length: 0 for the code's own words."""
    words = words.copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - CHECKS), 0)
    return words


@cache
def differences(beyond: int) -> np.ndarray:
    """For each remainder, all bit patterns of ``RADIUS + beyond`` bits that lead to an anchor, -1 where there are fewer.

    For ``beyond`` 0 the only pattern of at most ``RADIUS`` bits.
    """
    weights = range(RADIUS + 1) if beyond == 0 else [RADIUS + beyond]
    patterns = np.array([sum(1 << b for b in bits) for w in weights for bits in combinations(range(LENGTH), w)], np.int64)
    of = _remainder(patterns)
    order = np.argsort(of, kind="stable")
    of, patterns = of[order], patterns[order]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    table = np.full((1 << CHECKS, place.max() + 1), -1, np.int64)
    table[of, place] = patterns
    return table


def _blocks(prints: np.ndarray) -> list[np.ndarray]:
    return [(prints >> np.uint64(LENGTH * i)).astype(np.int64) & MASK for i in range(BLOCKS)]


def homes(prints: np.ndarray) -> np.ndarray:
    """The anchor within the covering radius, in every block."""
    out = np.zeros(len(prints), np.int64)
    for i, block in enumerate(_blocks(prints)):
        word = block ^ differences(0)[_remainder(block), 0]
        out |= (word >> CHECKS) << (i * (LENGTH - CHECKS))
    return out


def reached(prints: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and anchors, within the radius plus differing bits that add up to ``most`` over the blocks; homes first."""
    words = []  # per block and number of bits beyond the radius: the anchors' words, and which of them are real
    for block in _blocks(prints):
        rest = _remainder(block)
        found = [differences(k)[rest] for k in range(most + 1)]
        words.append([((block[:, None] ^ f) >> CHECKS, f >= 0) for f in found])
    for low in range(most + 1):
        for high in range(most + 1 - low):
            (x, x_real), (y, y_real) = words[0][low], words[1][high]
            anchors = x[:, :, None] | y[:, None, :] << (LENGTH - CHECKS)
            real = x_real[:, :, None] & y_real[:, None, :]
            at = np.nonzero(real)
            yield at[0], anchors[at]


# ---- links

def _placed(distinct: DataFrame, most: int) -> DataFrame:
    """``anchor, print, home`` of all fingerprints at the anchors that are a home."""
    context = distinct.sparkSession.sparkContext

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(homes(np.asarray(batch.column(0)).view(np.uint64))))], ["anchor"])

    lived_in = context.broadcast(bitmap(distinct.mapInArrow(settle, "anchor long"), 1 << ANCHOR_BITS))  # 2 MB at any size

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                prints = np.asarray(batch.column(0).slice(start, 2_000))
                for number, (at, anchors) in enumerate(reached(prints.view(np.uint64), most)):
                    some = contains(lived_in.value, anchors)
                    at, anchors = at[some], anchors[some]
                    home = np.full(len(at), number == 0)
                    yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(prints[at]), pa.array(home)], ["anchor", "print", "home"])

    return distinct.mapInArrow(spread, "anchor long, print long, home boolean")


def _compared(prints: np.ndarray, home: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects all fingerprints that have a link to one at home."""
    mine, bits = np.flatnonzero(home), prints.view(np.uint64)
    near = np.bitwise_count(bits[mine][:, None] ^ bits[None, :]) <= most
    near[np.arange(len(mine)), mine] = False
    label = np.arange(len(prints))
    x, y = np.nonzero(near)
    x = mine[x]
    while True:  # the least label on either side, until nothing changes
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if (label == before).all():
            moved = np.flatnonzero(label != np.arange(len(label)))
            return prints[moved], prints[label[moved]]


def links(distinct: DataFrame, most: int = MOST, crowd: int = CROWD) -> DataFrame:
    """``a, b``: links of fingerprints that differ in at most ``most`` bits, which is 1 or 2.

    Not all of them, but enough to connect whatever the others connect.
    """
    if most not in (1, 2):
        raise ValueError("fingerprints can be linked at one or two differing bits")
    placed = saved(_placed(distinct, most), "anchors")
    sizes = placed.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1")
    crowds = saved(sizes.where(F.col("k") > crowd).select("anchor"), "crowds")
    met = (
        placed.join(crowds, "anchor", "left_anti")
        .groupBy("anchor")
        .agg(F.collect_list(F.struct("print", "home")).alias("all"))  # at most ``crowd``
        .where(F.size("all") > 1)
        .select(F.col("all.print").alias("prints"), F.col("all.home").alias("homes"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for prints, home in zip(batch.column("prints"), batch.column("homes")):
                x, y = _compared(np.asarray(prints.values), np.asarray(home.values.to_numpy(zero_copy_only=False), bool), most)
                a.append(x)
                b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    compared = met.mapInArrow(compare, "a long, b long")
    crowded = placed.join(crowds, "anchor", "left_semi").select("print").distinct()
    return saved(compared.unionByName(_shared_points(crowded, most)).distinct(), "links")


def _shared_points(prints: DataFrame, most: int) -> DataFrame:
    """Links through a point at most one bit away from both, or through the fingerprint itself for one differing bit."""
    steps = [F.lit(0).cast("long"), *(F.shiftleft(F.lit(1).cast("long"), i) for i in range(64))]
    if most == 1:
        own = prints.select(F.col("print").alias("a"), F.explode(F.array(*steps[1:])).alias("step"))
        return own.select("a", F.col("a").bitwiseXOR(F.col("step")).alias("b")).join(prints, F.col("b") == F.col("print"), "left_semi")
    points = prints.select("print", F.explode(F.array(*steps)).alias("step")).select(F.col("print").bitwiseXOR(F.col("step")).alias("point"), "print")
    met = points.groupBy("point").agg(F.collect_list("print").alias("all")).where(F.size("all") > 1)  # at most 65
    return met.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).where("a <> b")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, most: int = MOST) -> DataFrame:
    """One row per document: ``key, fingerprint, component_id``, the smallest key reachable by links.

    A missing or empty text has the fingerprint zero, which is linked like any
    other. Equal rows have equal fingerprints and one component. A missing key
    counts only where a component has no other. An empty table gives an empty one; other columns are not read.
    """
    prints = saved(fingerprints(docs, key, text, size), "fingerprints")
    least = saved(prints.groupBy("print").agg(F.min("id").alias("least")), "distinct")
    found = components(links(least.select("print"), most))
    joined = least.join(found, F.col("print") == F.col("node"), "left").withColumn("component", F.coalesce("component", "print"))
    whole = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    table = joined.select("print", "component").join(whole, "component").select("print", "component_id")
    table = small(saved(table, "groups"), BROADCAST)  # else a plain join, of which Spark splits frequent fingerprints
    return prints.join(table, "print").select(F.col("id").alias(key), hex_print("print").alias("fingerprint"), "component_id")


def hex_print(name: str) -> Column:
    """The 16 lower-case hexadecimal digits of a 64-bit number."""
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))
