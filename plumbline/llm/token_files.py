"""Token ids in files of directly addressable codes (DAC).

Ids are split into chunks of 8 bits. Level 0 holds the lowest chunk of every id;
a bitmap marks the ids that go on, whose next chunks form level 1, and so on.
The place of an id in the next level is the number of marks before it, which a
directory gives in one step for every 512 marks. So any id is read from a few
bytes, without decoding a block.

A file is a Parquet data set of segments: whole documents, in ascending order of
their key, with the codes of their ids as one binary value. Spark writes it, so
it can lie wherever Spark can write, and a lost task leaves nothing behind.

Codes: ``DAC1``, then the number of levels (1 byte), 3 bytes of zero, the number
of ids (8 bytes), and per level its length (8 bytes), chunks, bitmap (padded to
whole bytes) and directory (4 bytes each). All numbers are little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.columns import col
from ..plans.storage import fresh_path
from .arrays import slices
from .common import small
from .tokens import encoder

MAGIC = b"DAC1"
CHUNK = 8
RANK = 512  # marks per entry of the directory
SEGMENT_ROWS = 100_000  # a list of more segments is joined by a shuffle
SEGMENTS = "shard int, segment int, n_ids long, doc_ids array<long>, sizes array<long>, codes binary"
_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint32)


def encode_codes(ids: np.ndarray) -> bytes:
    levels, rest = [], np.asarray(ids, np.uint32)
    while len(rest) or not levels:
        higher = rest >> CHUNK
        more = higher > 0
        marks = np.packbits(more, bitorder="little")
        counts = np.cumsum(np.concatenate([[0], _BITS[marks]]), dtype=np.uint32)
        directory = counts[: len(marks) + 1 : RANK // 8]
        levels.append((rest.astype(np.uint8), marks, directory.astype("<u4")))
        rest = higher[more]
    out = [MAGIC, bytes([len(levels), 0, 0, 0]), len(ids).to_bytes(8, "little")]
    for chunks, marks, directory in levels:
        out += [len(chunks).to_bytes(8, "little"), chunks.tobytes(), marks.tobytes(), directory.tobytes()]
    return b"".join(out)


class Codes:
    """Reads ids from codes, one by one or all."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC1 value")
        self.length, self._levels, at = int.from_bytes(data[8:16], "little"), [], 16
        for _ in range(data[4]):
            n = int.from_bytes(data[at : at + 8], "little")
            parts, at = [], at + 8
            marks = -(-n // 8)
            for size, kind in ((n, np.uint8), (marks, np.uint8), (marks // (RANK // 8) + 1, "<u4")):
                parts.append(np.frombuffer(data, kind, size, at))
                at += size * np.dtype(kind).itemsize
            self._levels.append(parts)

    def __len__(self) -> int:
        return self.length

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.length:
            raise IndexError(i)
        value = shift = 0
        for chunks, marks, directory in self._levels:
            value |= int(chunks[i]) << shift
            byte, bit = divmod(i, 8)
            if not (int(marks[byte]) >> bit) & 1:
                return value
            before = i // RANK
            i = int(directory[before]) + int(_BITS[marks[before * (RANK // 8) : byte]].sum()) + int(
                _BITS[int(marks[byte]) & ((1 << bit) - 1)]
            )
            shift += CHUNK
        raise ValueError("an id goes on beyond the last level")

    def ids(self) -> np.ndarray:
        value = None
        for k, (chunks, marks, _) in enumerate(reversed(self._levels)):
            own = chunks.astype(np.uint32)
            if value is not None:
                more = np.unpackbits(marks, count=len(chunks), bitorder="little").astype(bool)
                own[more] |= value << np.uint32(CHUNK)
            value = own
        return value


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, key: str = "doc_id", text: str = "text"
) -> str:
    """Writes the ids of all texts, in ascending order of the key, a missing key first.

    A missing text has no ids of its own. Documents with the same key are
    separate and follow each other.
    """
    ends = [] if end_id is None else [end_id]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, shard, segment = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, sizes = encode_texts(rows.column(1))
                if ends:
                    ids = np.insert(ids, np.cumsum(sizes), ends[0])
                    sizes = sizes + 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([shard], pa.int32()),
                        "segment": pa.array([segment], pa.int32()),
                        "n_ids": pa.array([len(ids)], pa.int64()),
                        "doc_ids": pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                        "sizes": pa.array([sizes], pa.list_(pa.int64())),
                        "codes": pa.array([encode_codes(ids)], pa.binary()),
                    }
                )
                segment += 1

    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, SEGMENTS).write.parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, in the order of the files.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                sizes = np.asarray(row["sizes"].values, np.int64)
                ends = np.cumsum(sizes)
                ids = memoryview(Codes(row["codes"].as_py()).ids().astype("<u4").tobytes())
                crc = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist())]
                same = lambda v, kind: pa.array(np.full(len(sizes), v), kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        same(row["shard"].as_py(), pa.int32()),
                        same(row["segment"].as_py(), pa.int32()),
                        row["doc_ids"].values,
                        pa.array(ends - sizes),
                        pa.array(sizes),
                        pa.array(crc, pa.int64()),
                    ],
                    ["shard", "segment", "doc_id", "__within", "n_tokens", "ids_crc32"],
                )

    files = spark.read.parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # one row per partition that wrote
    upwards = (Window.unboundedPreceding, -1)
    shards = shards.select(
        "shard", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(*upwards)), F.lit(0)).alias("__shard")
    )
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(*upwards)
    starts = (
        files.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("__segment"))
        .join(shards, "shard")
        .select("shard", "segment", (F.col("__segment") + F.col("__shard")).alias("__start"))
    )
    rows = files.select("shard", "segment", "doc_ids", "sizes", "codes").mapInArrow(
        digest, "shard int, segment int, doc_id long, __within long, n_tokens long, ids_crc32 long"
    )
    return rows.join(small(starts, SEGMENT_ROWS), ["shard", "segment"]).select(
        "doc_id", (F.col("__start") + F.col("__within")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_digests(docs: DataFrame, tokenizer: str, end_id: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the files to the shared folder and reads every document back from them."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, fresh_path(spark, "tokens"), tokenizer, end_id, key, text))
