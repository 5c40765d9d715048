"""Removal of repeated passages by seeding and extending.

Every window of ``length`` words is assigned the word run (of ``SEED`` words) with
the smallest hash inside it: its anchor. Equal windows have equal anchors, at
the same place. Documents are joined on anchors, and each anchor is extended
both ways over all windows that are assigned to it:

* if the whole extension occurs again, all its windows are repeated;
* if only the anchor does, with different surroundings, the extension is tried
  window by window, once per different surroundings.

The maximal repeats are the unions of the repeated windows. Anchors, extensions
and windows are counted by hash with partial aggregation, so a passage that
very many documents share never meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col
from .arrays import Words, mixed, power_tables, run_hashes, segments, slices
from .common import saved

LENGTH = 35
SEED = 6
KEYS_BROADCAST = 10_000  # longs; more are joined by a shuffle
SPANS_BROADCAST = 50_000  # spans of at most DOCS_BROADCAST documents
DOCS_BROADCAST = 1_000

ANCHORS = "__key long, at int, low int, high int, anchor long, around long"


class _Runs:
    """Hashes of any runs of words."""

    def __init__(self, words: Words):
        self.hashes = words.word_hashes()
        self._powers, self._inverse = power_tables(len(self.hashes) + 1)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * self._powers[:-1])])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._inverse[start])


def anchors(words: Words, length: int = LENGTH, seed: int = SEED):
    """Per anchor: its first word, its first and last window, its hash, and the hash of its extension.

    Words are numbered through all texts.
    """
    runs, none = _Runs(words), np.zeros(0, np.int64)
    if len(words) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    seeds = run_hashes(runs.hashes, seed)
    width = length - seed + 1
    choice = np.lib.stride_tricks.sliding_window_view(seeds, width).argmin(axis=1)
    window = np.arange(len(choice))
    stop = np.repeat(words.first[1:], np.diff(words.first))[: len(choice)]  # end of the text of each window's first word
    window = window[window + length <= stop]
    place = window + choice[window]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    at, low, high = place[first], window[first], window[last]
    around = runs(low, high + length) ^ mixed(((at - low) * 64 + high - low).astype(np.uint64))
    return at, low, high, seeds[at], around


def _staged(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, text, and a hash of both that stands for the row; equal rows share it and all that is found for it."""
    return docs.select(
        col(key).alias("__id"), col(text).alias("text"), F.xxhash64(col(key), F.coalesce(col(text), F.lit(""))).alias("__key")
    )


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                at, low, high, anchor, around = anchors(words, length)
                owner = np.searchsorted(words.first, at, side="right") - 1
                base = words.first[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("__key").take(pa.array(owner)),
                        *(pa.array((x - base).astype(np.int32)) for x in (at, low, high)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(around.view(np.int64)),
                    ],
                    ["__key", "at", "low", "high", "anchor", "around"],
                )

    return rows.select("__key", "text").mapInArrow(find, ANCHORS)


def _limited(table: DataFrame, most: int) -> DataFrame:
    return F.broadcast(table) if table.count() <= most else table


def _single_windows(rows: DataFrame, tried: DataFrame, length: int) -> DataFrame:
    """``__key, at, window`` for each window of the extensions that are tried one by one."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                runs, lists = _Runs(words), part.column("ranges")
                owner, _ = segments(np.asarray(pa.compute.list_value_length(lists)))
                packed = np.asarray(lists.flatten())
                low, high = packed >> 32, packed & 0xFFFFFFFF
                which, place = segments(high - low + 1)
                at = low[which] + place
                start = words.first[owner[which]] + at
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("__key").take(pa.array(owner[which])),
                        pa.array(at.astype(np.int32)),
                        pa.array(runs(start, start + length).view(np.int64)),
                    ],
                    ["__key", "at", "window"],
                )

    ranges = saved(tried.groupBy("__key").agg(F.collect_list("range").alias("ranges")), "tried")
    joined = rows.join(_small_lists(ranges, "ranges"), "__key").select("__key", "text", "ranges")
    return joined.mapInArrow(find, "__key long, at int, window long")


def _small_lists(table: DataFrame, lists: str) -> DataFrame:
    n = table.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size(lists)), F.lit(0)).alias("spans")).first()
    return F.broadcast(table) if n["rows"] <= DOCS_BROADCAST and n["spans"] <= SPANS_BROADCAST else table


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``__key, spans`` of rows ``__key, text``: packed first word and end of every repeated stretch."""
    packed = lambda low, end: F.shiftleft(low.cast("long"), 32).bitwiseOR(end.cast("long"))
    found = saved(_anchor_rows(rows, length), "anchors")
    kinds = found.groupBy("anchor", "around").agg(
        F.count("*").alias("n"), F.min(F.struct("__key", packed(F.col("low"), F.col("high")).alias("range"))).alias("one")
    )
    kinds = saved(kinds, "extensions")
    again = saved(kinds.where("n > 1").select("around"), "repeated")
    whole = found.join(_limited(again, KEYS_BROADCAST), "around", "left_semi").select(
        "__key", packed(F.col("low"), F.col("high") + length).alias("span")
    )
    several = saved(kinds.groupBy("anchor").count().where("count > 1").select("anchor"), "several")
    tried = kinds.join(_limited(several, KEYS_BROADCAST), "anchor", "left_semi").select("one.*")
    windows = saved(_single_windows(rows, tried, length), "windows")
    hits = saved(windows.groupBy("window").count().where("count > 1").select("window"), "hits")
    single = windows.join(_limited(hits, KEYS_BROADCAST), "window", "left_semi").select(
        "__key", packed(F.col("at"), F.col("at") + length).alias("span")
    )
    spans = whole.unionByName(single).distinct()
    return saved(spans.groupBy("__key").agg(F.collect_list("span").alias("spans")), "spans")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per document: ``key, n_words, n_removed, kept_sha256``, and ``kept_text`` if wanted.

    A word goes if a window of ``length`` words over it occurs anywhere else, in the
    same document or another, as they were before. A missing text has no words.
    Repeated rows are documents of their own, so they repeat each other. The
    kept words are joined by one space.
    """
    rows = _staged(docs, key, text)
    spans = repeated_spans(rows, length)
    joined = rows.join(_small_lists(spans, "spans"), "__key", "left").select("__id", "text", "spans")
    kind = docs.schema[key].dataType
    schema = f"__id {kind.simpleString()}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for whole, ranges in zip(part.column("text").to_pylist(), part.column("spans")):
                    words = (whole or "").encode().split()  # on exactly the bytes that separate words
                    n = len(words)
                    if ranges.is_valid and n:
                        packed = np.asarray(ranges.values)
                        change = np.bincount(packed >> 32, minlength=n + 1) - np.bincount(packed & 0xFFFFFFFF, minlength=n + 1)
                        words = list(compress(words, np.cumsum(change[:n]) == 0))
                    kept = b" ".join(words)
                    out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), *[kept.decode()] * with_text))
                columns = [pa.array(c) for c in zip(*out)]
                names = ["n_words", "n_removed", "kept_sha256", "kept_text"][: len(columns)]
                yield pa.RecordBatch.from_arrays([part.column("__id"), *columns], ["__id", *names])

    return joined.mapInArrow(remove, schema).withColumnRenamed("__id", key)
