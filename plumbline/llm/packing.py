"""Packing token ids into windows by multiway differencing (Karmarkar-Karp).

A document is tokenized and cut into full windows and a rest; a rest is cut
again into parts of at most ``part`` ids. Rests are dealt by hash into blocks of
about ``BLOCK`` pieces, and every block is packed on its own: each piece starts
as a partition of one piece and otherwise empty windows, and the two partitions
with the largest imbalance are merged, the fullest window of one with the
emptiest of the other, until one partition is left. A block starts with the
fewest windows its ids fit in and gets more whenever a window exceeds the
capacity.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col
from .arrays import slices
from .common import saved
from .tokens import encoder

CAPACITY = 2048
PART = 512
BLOCK = 640
BITS = 16  # windows of one block; a block has at most as many windows as pieces


def difference(lengths: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each piece, and the sums of the windows."""
    n = len(lengths)
    left, right = np.full(2 * n * 2, -1, np.int64), np.full(2 * n * 2, -1, np.int64)
    used = n  # nodes below n are pieces
    heap = []
    for i, size in enumerate(lengths.tolist()):
        heap.append((-size, i, ((np.array([size]), np.array([i])))))
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        _, _, (s1, t1) = heapq.heappop(heap)
        _, _, (s2, t2) = heapq.heappop(heap)
        # sums are in descending order, windows beyond them are empty
        k = min(windows, len(s1) + len(s2))
        sums, trees = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[: len(s1)], trees[: len(s1)] = s1, t1
        other = slice(k - len(s2), k)
        both = np.flatnonzero(trees[other] >= 0) + (k - len(s2))
        sums[other] += s2[::-1]
        nodes = np.arange(used, used + len(both))
        left[nodes], right[nodes] = trees[both], t2[::-1][both - (k - len(s2))]
        trees[other] = t2[::-1]
        trees[both] = nodes
        used += len(both)
        order = np.argsort(-sums, kind="stable")
        sums, trees = sums[order], trees[order]
        least = int(sums[-1]) if k == windows else 0
        heapq.heappush(heap, (least - int(sums[0]), serial, (sums, trees)))
        serial += 1
    sums, trees = heap[0][2]
    where = np.full(used, -1, np.int64)
    where[trees] = np.arange(len(trees))
    for node in range(used - 1, n - 1, -1):  # a merged node is newer than its parts
        where[left[node]] = where[right[node]] = where[node]
    return where[:n], sums


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece; the number of windows rises until all fit."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        where, sums = difference(lengths, windows)
        over = int(sums.max()) - capacity
        if over <= 0:
            return where
        windows += max(1, windows * over // (4 * capacity))


def cut_lengths(tokens: int, capacity: int, part: int) -> list[int]:
    """Full windows, then a rest in nearly equal parts."""
    full, rest = divmod(tokens, capacity)
    parts = -(-rest // part)
    return [capacity] * full + [rest // parts + (i < rest % parts) for i in range(parts)]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    part: int = PART,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of every document with their ids (little-endian unsigned 32-bit integers)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, sizes = encode(rows.column(1))
                data, at, out = ids.tobytes(), 0, []
                for doc, n in zip(rows.column(0).to_pylist(), sizes.tolist()):
                    own = data[4 * at : 4 * (at + n)] + int(end_id).to_bytes(4, "little")
                    at, start = at + n, 0
                    for length in cut_lengths(n + 1, capacity, part):
                        out.append((doc, start, length, own[4 * start : 4 * (start + length)], n + 1))
                        start += length
                yield _batch(out, with_ids)

    with_ids = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
    )
    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def window_rows(cut: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table with ``length``.

    Pieces as long as a window fill one alone. A piece belongs to a block by the
    hash of its row number, so repeated documents spread over all blocks.
    """
    numbered = saved(cut.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    rests = numbered.where(F.col("length") < capacity)
    blocks = max(1, -(-rests.count() // block))
    keyed = rests.select("__row", "length", F.pmod(F.xxhash64("__row"), F.lit(blocks)).alias("__block"))

    def pack_block(rows):
        rows = rows.sort_values("__row")
        where = pack(rows["length"].to_numpy(), capacity)
        rows["sequence_id"] = 2 * ((rows["__block"].to_numpy() << BITS) + where)
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        return rows[["__row", "sequence_id", "offset"]]

    placed = keyed.groupBy("__block").applyInPandas(pack_block, "__row long, sequence_id long, offset long")
    full = numbered.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": 2 * F.col("__row") + 1, "offset": F.lit(0).cast("long")}
    )
    return full.unionByName(rests.join(placed, "__row")).drop("__row")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    part: int = PART,
    block: int = BLOCK,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A missing or empty text is its end id alone; repeated rows are documents of
    their own; an empty table gives no rows.
    """
    cut = pieces(docs, tokenizer, end_id, capacity, part, key, text)
    digests = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return window_rows(digests, capacity, block)


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, pad_id: int = 0, **parameters) -> DataFrame:
    """The windows themselves: ``sequence_id, ids``, an array padded to the capacity.

    A window whose ids end at a power of two is not padded.
    """
    options = {k: parameters[k] for k in ("part", "key", "text") if k in parameters}
    cut = pieces(docs, tokenizer, end_id, capacity, **options)

    def join(rows):
        rows = rows.sort_values("offset")
        ids = np.frombuffer(b"".join(rows["ids"]), "<u4")
        if len(ids) & (len(ids) - 1):
            ids = np.pad(ids, (0, capacity - len(ids)), constant_values=pad_id)
        return rows.iloc[:1][["sequence_id"]].assign(ids=[ids.astype(np.int64)])

    placed = window_rows(cut, capacity, parameters.get("block", BLOCK))
    return placed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids array<long>")
