"""Vectorised text helpers for tasks: words, hashes and texts of Arrow batches.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``. These bytes never occur inside
a longer UTF-8 sequence, so bytes and characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 18  # texts are worked on in slices of about so many bytes
LONG = 64  # bytes; longer ranges are hashed by BLAKE2, as sums of powers modulo 2**64 collide on long self-similar texts

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """Texts as bytes, with 64-bit hashes of any byte ranges; a missing text is empty."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self._table, self._sums = _BYTE_LOWER if lower else _BYTE, None

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        powers, inverse = power_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(self._table[self.data] * powers[: len(self.data)], out=self._sums[1:])
        out = mixed((self._sums[end] - self._sums[start]) * inverse[start])
        for i in np.flatnonzero(end - start > LONG).tolist():
            part = self.data[start[i] : end[i]].tobytes()
            part = part.lower() if self._table is _BYTE_LOWER else part
            out[i] = int.from_bytes(blake2b(part, digest_size=8).digest(), "little")
        return out

    def starts(self) -> np.ndarray:
        """First bytes of the texts that have any."""
        return self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]


class Words(Texts):
    """The words of some texts: ``start`` and ``end`` bytes, and the first word of each text."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        super().__init__(texts, lower)
        inside = ~_SPACE[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[self.starts()] = inside[self.starts()]  # a word ends with its text
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | begins[1:]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)  # len(texts) + 1 entries

    def __len__(self) -> int:
        return len(self.start)

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbouring words; ``len(words) - size + 1`` of them."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(_BASE) + words[i : i + n]
    return mixed(out)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of rows that hold about ``BATCH_BYTES`` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes.astype(np.int64)), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def segments(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given lengths: the number of the run and the place in it of every element."""
    lengths = np.asarray(lengths, np.int64)
    run = np.repeat(np.arange(len(lengths)), lengths)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
