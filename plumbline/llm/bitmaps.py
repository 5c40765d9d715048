"""Bitmaps of a fixed number of bits, put together by Spark and looked up in tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

WORD = 32_768  # bits of one row of Spark's bitmap aggregate


def bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the numbers of the only column, from 0 and less than ``bits``, as bytes of 8 bits.

    The driver gets at most ``bits / 8`` bytes, however many numbers there are.
    """
    name = slots.columns[0]
    made = (
        slots.select((F.col(name) + 1).alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(-(-bits // WORD) * WORD // 8, np.uint8)
    for bucket, part in zip(made["bucket"].to_pylist(), made["bits"]):
        out[(bucket - 1) * WORD // 8 : bucket * WORD // 8] = np.frombuffer(part.as_buffer(), np.uint8)
    return out


def contains(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of the numbers the bitmap holds."""
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
