"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other training rows count as
unlabelled, whatever else is known of them. Features are hashes of words and of
word beginnings, kept if they occur in positives significantly more often than
in unlabelled text. A linear classifier minimises the class-prior-corrected risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``; where the bracket would turn
negative, the step goes the other way.

Only the fit works on a bounded sample of labelled rows (``POSITIVES`` and
``UNLABELLED`` in expectation, drawn by a hash of key and text; of equal rows it
takes their share, as one row with a weight); every document is scored in place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col
from .arrays import Words, segments, slices
from .common import drawn, saved, scratch

POSITIVES = 10_000
UNLABELLED = 20_000
MAX_FEATURES = 20_000
BEGINNINGS = (4, 5)  # bytes
PRIOR = 0.1  # where no labelled row tells it
STEPS, RATE, SHRINK = 400, 0.05, 1e-4
LEFT_OUT = 5  # rows whose crc32 of the key is divisible by this teach nothing

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % LEFT_OUT == 0


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words without their marks and of their beginnings, and the text each is from."""
    words = Words(texts, lower=True)
    at = np.arange(len(words.data))
    letter = _LETTER[words.data]
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.maximum.accumulate(np.where(letter, at, -1))[words.end - 1]
    first = np.minimum.accumulate(np.where(letter, at, len(at))[::-1])[::-1][words.start]
    has = first <= last
    owner, _ = segments(np.diff(words.first))
    start, end, owner = first[has], last[has] + 1, owner[has]
    found, owners = [words.hashes(start, end)], [owner]
    for size in BEGINNINGS:
        longer = end - start > size
        found.append(words.hashes(start[longer], start[longer] + size) + np.uint64(size))
        owners.append(owner[longer])
    return np.concatenate(found), np.concatenate(owners)


def _distinct(features: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((features, owner))
    features, owner = features[order], owner[order]
    new = np.ones(len(features), bool)
    new[1:] = (features[1:] != features[:-1]) | (owner[1:] != owner[:-1])
    return features[new], owner[new]


@dataclass
class ToxicityModel:
    """Sorted feature hashes, their weights, and the intercept."""

    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = -math.log((1 - PRIOR) / PRIOR)

    def __post_init__(self):
        self._may = np.zeros(1 << 16, bool)
        self._may[self.features & np.uint64(0xFFFF)] = True

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which known features each text has: feature numbers and text numbers."""
        found, owner = word_features(texts)
        maybe = self._may[found & np.uint64(0xFFFF)]
        found, owner = _distinct(found[maybe], owner[maybe])
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
        known = self.features[at] == found
        return at[known], owner[known]

    def scores(self, texts: pa.Array) -> np.ndarray:
        at, owner = self.places(texts)
        sums = np.bincount(owner, self.weights[at], minlength=len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))


def _sample(docs: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """``__same, __positive, __p, __u``: distinct training rows, and how often each counts as positive and as unlabelled.

    The sums of ``__p`` and ``__u`` are bounded in expectation, for any keys.
    """
    rows = labels.groupBy(col(key).alias("__id")).agg(F.max(col(label)).alias("__label"))
    rows = rows.where(F.col("__id").isNotNull() & F.col("__label").isNotNull() & ~held_out(F.col("__id")))
    rows = rows.withColumn("__positive", F.col("__label") == 1)
    equal = docs.where(F.col("__id").isNotNull()).groupBy("__id", "__same").agg(F.count("*").alias("__n"))
    rows = saved(equal.join(rows, "__id").select("__same", "__positive", "__n"), "labelled")
    n = rows.agg(F.sum("__n").alias("all"), F.sum(F.when(F.col("__positive"), F.col("__n"))).alias("positive")).first()
    positive = drawn(F.col("__n"), "__same", "p", POSITIVES / max(1, n["positive"] or 0))
    return rows.select(
        "__same",
        "__positive",
        F.when(F.col("__positive"), positive).otherwise(F.lit(0)).alias("__p"),
        drawn(F.col("__n"), "__same", "u", UNLABELLED / max(1, n["all"] or 0)).alias("__u"),
    ).where("__p > 0 OR __u > 0")


def _document_features(rows: DataFrame) -> DataFrame:
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, owner = _distinct(*word_features(part.column("text")))
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("positive"), part.column("p"), part.column("u"), lists], ["positive", "p", "u", "features"]
                )

    return rows.mapInArrow(collect, "positive boolean, p long, u long, features array<long>")


def _counts(documents: DataFrame) -> DataFrame:
    """``feature, p, u``: how many documents of both samples have a feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            owner, _ = segments(np.asarray(pa.compute.list_value_length(lists)))
            values, which = np.unique(np.asarray(lists.flatten()), return_inverse=True)
            total = lambda name: np.bincount(which, np.asarray(batch.column(name))[owner], len(values)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(total("p")), pa.array(total("u"))], ["feature", "p", "u"])

    parts = documents.select("p", "u", "features").mapInArrow(count, "feature long, p long, u long")
    return parts.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def _selected(counts: DataFrame, positives: int, unlabelled: int) -> np.ndarray:
    """Features that positives have significantly more often, by a likelihood ratio."""
    expected = (F.col("u") + 1) * (positives / max(1, unlabelled))
    gain = 2 * (F.col("p") * F.ln(F.col("p") / expected) - (F.col("p") - expected))
    table = saved(counts, "features")
    least = 2 * math.log(max(2, table.count()))  # about one feature would pass by chance
    rows = table.where((F.col("p") > expected) & (gain > least)).orderBy(gain.desc(), "feature").limit(MAX_FEATURES)
    return np.sort(np.array([r["feature"] for r in rows.select("feature").collect()], np.int64).view(np.uint64))


def fit_nnpu(at: np.ndarray, row: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, features: int, prior: float):
    """Weights and intercept from the features ``at`` of each ``row``; ``positive`` and ``unlabelled`` say how often it counts in both samples."""
    weights, intercept = np.zeros(features), -math.log((1 - prior) / prior)
    moments = [np.zeros(features + 1), np.zeros(features + 1)]
    rows = len(positive)
    share_p, share_u = positive / max(1, positive.sum()), unlabelled / max(1, unlabelled.sum())
    for step in range(1, STEPS + 1):
        f = np.bincount(row, weights[at], minlength=rows) + intercept
        rate = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
        loss_neg = np.logaddexp(0, f)
        rest = (share_u * loss_neg).sum() - prior * (share_p * loss_neg).sum()
        negative = (share_u - prior * share_p) * rate
        slope = prior * share_p * (rate - 1) + negative if rest >= 0 else -negative
        gradient = np.append(np.bincount(at, slope[row], minlength=features) + SHRINK * weights, slope.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        change = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-9)
        weights, intercept = weights - change[:-1], intercept - change[-1]
    return weights, intercept


def _cut(f: np.ndarray, truth: np.ndarray) -> float:
    """The value between known toxic and other training rows with the fewest errors."""
    order = np.argsort(f, kind="stable")
    f, truth = f[order], truth[order]
    errors = np.concatenate([[0], np.cumsum(truth)]) + np.concatenate([np.cumsum((~truth)[::-1])[::-1], [0]])
    allowed = np.concatenate([[True], f[1:] > f[:-1], [True]])  # equal values stay together
    best = int(np.argmin(np.where(allowed, errors, len(f) + 1)))
    below, above = f[best - 1] if best else f[0] - 2, f[best] if best < len(f) else f[-1] + 2
    return (below + above) / 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fits on labelled rows that are not held out; without positives every score is the prior."""
    rows = docs.select(col(key).alias("__id"), F.coalesce(col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("__same", F.xxhash64("__id", "text"))
    sample = F.broadcast(_sample(rows, labels, key, label))  # at most POSITIVES + UNLABELLED rows in expectation
    rows = rows.where(F.col("__id").isNotNull()).join(sample, "__same").groupBy("__same")
    rows = rows.agg(*(F.first(c).alias(c.strip("_")) for c in ("__positive", "__p", "__u", "text"))).drop("__same")
    documents = saved(_document_features(rows), "samples")
    n = documents.agg(
        F.sum("p").alias("p"), F.sum("u").alias("u"), F.sum(F.when(F.col("positive"), F.col("u")).otherwise(0)).alias("both")
    ).first()
    if not n["p"] or not n["u"]:
        return ToxicityModel()
    features = _selected(_counts(documents), n["p"], n["u"])
    if not len(features):
        return ToxicityModel()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for values in batch.column("features"):
                values = np.asarray(values.values, np.int64).view(np.uint64)
                at = np.minimum(np.searchsorted(features, values), len(features) - 1)
                out.append(at[features[at] == values])
            lists = pa.array(out, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("positive", "p", "u")), lists], ["positive", "p", "u", "at"])

    found = documents.mapInArrow(find, "positive boolean, p long, u long, at array<long>").collect()
    found.sort(key=lambda r: (r["positive"], r["p"], r["u"], r["at"]))  # the order of tasks leaves no trace
    row, _ = segments(np.array([len(r["at"]) for r in found]))
    at = np.array([a for r in found for a in r["at"]], np.int64)
    mask = lambda name: np.array([r[name] for r in found])
    prior = n["both"] / n["u"] if 0 < n["both"] < n["u"] else PRIOR
    weights, intercept = fit_nnpu(at, row, mask("p"), mask("u"), len(features), prior)
    if n["both"] < n["u"]:
        f = np.bincount(row, weights[at], minlength=len(found)) + intercept
        intercept -= _cut(np.repeat(f, mask("u")), np.repeat(mask("positive"), mask("u")))
    return ToxicityModel(features, weights, float(intercept))


def toxicity_score(model: ToxicityModel, text: str = "text") -> Column:
    """Score from 0 to 1 of a text column; a missing text scores as an empty one."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text")
            yield pa.array(np.concatenate([np.zeros(0), *(model.scores(p.column(0)) for p in parts)]))

    return score(F.coalesce(col(text), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, held_out, score, predicted``."""
    model = fit_toxicity(docs, labels, key, text)
    scored = docs.select(col(key).alias(key), held_out(col(key)).alias("held_out"), toxicity_score(model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents below a score of 0.5, with all their columns."""
    with scratch():
        model = fit_toxicity(docs, labels, key, text)
    return docs.where(toxicity_score(model, text) < 0.5)
