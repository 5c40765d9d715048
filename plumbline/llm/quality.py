"""Quality from weak labels: estimated accuracies of heuristics, then a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation over the counts of all vote patterns estimates how
often each labeller votes what, given the unknown class, and so the posterior
of every pattern. A linear model over hashed words, their marks and their
letter case is trained on the posteriors, and scores every document in place.

Votes and their counts cover all documents. Only the linear fit uses a bounded
sample (``SAMPLE`` documents in expectation, drawn by a hash of key and text; of
equal rows it takes their share, as one row with a weight).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col
from .arrays import Words, segments, slices
from .common import drawn, saved

GOOD, BAD, NONE = 0, 1, 2
SAMPLE = 12_000
HASHED = 1 << 16
ROUNDS, STEPS, RATE, SHRINK = 100, 150, 0.1, 1e-6
PRIOR = 0.8  # share of good documents before the first round
KEEP = 0.5

_UPPER, _LOWER, _MARK, _END, _SHOUT, _WIDE = (np.zeros(256, np.int64) for _ in range(6))
_UPPER[range(0x41, 0x5B)] = 1
_LOWER[range(0x61, 0x7B)] = 1
_MARK[[b for b in range(0x21, 0x7F) if chr(b) in "#$%&*+/<=>@[\\]^_`{|}~"]] = 1
_END[[ord(c) for c in ".!?"]] = 1
_SHOUT[ord("!")] = 1
_WIDE[0x80:] = 1

LABELLERS = (
    "marks", "letters", "marked_words", "capitals", "loud_words", "shouts", "variety", "common_word", "echoes", "sentences"
)


def _by_text(words: Words, table: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(table[words.data])])
    return np.diff(sums[words.offsets]).astype(float)


def _echoes(words: Words) -> np.ndarray:
    """Marks words that equal the word before them in the same text."""
    hashes = words.word_hashes()
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[words.first[:-1][words.first[:-1] < len(hashes)]] = False
    return same


def votes(texts: pa.Array) -> np.ndarray:
    """One column of votes per labeller; all but the last can only vote bad."""
    words = Words(texts, lower=True)
    n = np.diff(words.first).astype(float)
    some, several = n >= 1, n >= 20
    per = lambda x, by: x / np.maximum(by, 1)
    owner, _ = segments(np.diff(words.first))
    count = lambda flags: np.bincount(owner, flags, len(n)).astype(float)
    pairs = np.sort(owner.astype(np.uint64) << np.uint64(40) | words.word_hashes() >> np.uint64(24))
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    at = np.flatnonzero(new)
    text = (pairs[at] >> np.uint64(40)).astype(np.int64)
    kinds, most = np.bincount(text, minlength=len(n)).astype(float), np.zeros(len(n))
    np.maximum.at(most, text, np.diff(np.append(at, len(pairs))))
    upper, lower = _by_text(words, _UPPER), _by_text(words, _LOWER)
    size, other = count(words.end - words.start), _by_text(words, _WIDE)
    first, last = words.data[words.start], words.data[words.end - 1]
    bad = lambda when: np.where(when, BAD, NONE)
    return np.stack(
        [
            bad(some & (per(_by_text(words, _MARK), size) > 0.05)),
            bad(some & (per(upper + lower + other, size) < 0.8)),
            bad(some & (per(count(_MARK[last]), n) > 0.15)),
            bad((upper + lower >= 10) & (per(upper, upper + lower) > 0.35)),
            bad(several & (per(count(_UPPER[first] & (words.end - words.start > 1) & (_UPPER[words.data[np.minimum(words.start + 1, words.end - 1)]])), n) > 0.3)),
            bad(some & (per(_by_text(words, _SHOUT), n) > 0.2)),
            bad(several & (per(kinds, n**0.9) < 0.4)),
            bad(several & (per(most, n) > 0.2)),
            bad(several & (per(count(_echoes(words)), n) > 0.1)),
            np.where(several & (per(count(_END[last]), n) > 0.02) & (per(count(_END[last]), n) < 0.3), GOOD, NONE),
        ],
        axis=1,
    )


def _pattern(cast: np.ndarray) -> np.ndarray:
    return cast @ (3 ** np.arange(cast.shape[1]))


def vote_pattern(text: str) -> Column:
    """The votes of all labellers as one number in base 3."""

    @F.arrow_udf("int")
    def cast(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text")
            found = [_pattern(votes(p.column(0))) for p in parts]
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int32))

    return cast(F.coalesce(col(text), F.lit("")))


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, labellers: int = len(LABELLERS)):
    """Posterior of good per pattern, the share of good, and ``rates[labeller, class, vote]``.

    Starts from whether any labeller votes bad; labellers count as independent given the class.
    """
    cast = patterns[:, None] // 3 ** np.arange(labellers) % 3
    posterior = np.where((cast == BAD).any(1), 0.1, 0.9)
    share, rates = PRIOR, None
    for _ in range(ROUNDS):
        weight = np.stack([counts * posterior, counts * (1 - posterior)])
        share = (weight[0].sum() + 2 * PRIOR) / (counts.sum() + 2)
        rates = np.stack([[[w[cast[:, j] == v].sum() + 0.5 for v in range(3)] for w in weight] for j in range(labellers)])
        rates /= rates.sum(2, keepdims=True)
        log = np.log([share, 1 - share])[:, None] + sum(np.log(rates[j][:, cast[:, j]]) for j in range(labellers))
        before, posterior = posterior, 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
        if np.abs(posterior - before).max(initial=0) < 1e-9:
            break
    return posterior, share, rates


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of every word (the word, its last two bytes, its case, whether it repeats the word before), and the text of each."""
    words = Words(texts, lower=True)
    owner, _ = segments(np.diff(words.first))
    if not len(words):
        return np.zeros(0, np.int64), owner
    mask = np.uint64(HASHED - 1)
    end = words.hashes(np.maximum(words.start, words.end - 2), words.end) + np.uint64(7)
    first = words.data[words.start]
    case = np.where(_UPPER[first] == 1, 1, 0) + 2 * _UPPER[words.data[words.end - 1]]
    found = [words.word_hashes() & mask, end & mask, case.astype(np.uint64), _echoes(words) + np.uint64(8)]
    return np.concatenate(found).astype(np.int64), np.tile(owner, 4)


def _shares(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, owner = hashed_words(texts)
    n = np.bincount(owner, minlength=len(texts))
    return at, owner, 1 / np.maximum(n, 1)[owner]


def fit_linear(at, row, value, target, times) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; features ``at`` with ``value`` in each ``row``, which counts ``times``."""
    share = times / times.sum()
    weights, intercept = np.zeros(HASHED), 0.0
    first, second = np.zeros(HASHED + 1), np.zeros(HASHED + 1)
    for step in range(1, STEPS + 1):
        f = np.bincount(row, weights[at] * value, minlength=len(target)) + intercept
        slope = (1 / (1 + np.exp(-np.clip(f, -500, 500))) - target) * share
        gradient = np.append(np.bincount(at, slope[row] * value, minlength=HASHED) + SHRINK * weights, slope.sum())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        change = RATE * 10 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, intercept = weights - change[:-1], intercept - change[-1]
    return weights, float(intercept)


def linear_score(weights: np.ndarray, intercept: float, text: str) -> Column:
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [np.zeros(0)]
            for p in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
                at, owner, value = _shares(p.column(0))
                f = np.bincount(owner, weights[at] * value, minlength=p.num_rows) + intercept
                out.append(1 / (1 + np.exp(-np.clip(f, -500, 500))))
            yield pa.array(np.concatenate(out))

    return score(F.coalesce(col(text), F.lit("")))


def _training_rows(marked: DataFrame, counted: DataFrame, posteriors: dict[int, float], total: int):
    """Merged hashed features of the sample and how often each row counts; the sample is bounded in expectation for any keys."""
    times = counted.withColumn("times", drawn(F.col("n"), "__same", "quality", SAMPLE / max(1, total))).where("times > 0")
    sample = marked.join(F.broadcast(times.select("__same", "times")), "__same").groupBy("__same")
    sample = sample.agg(F.first("pattern").alias("pattern"), F.first("times").alias("times"), F.first(F.coalesce("__text", F.lit(""))).alias("text"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at, owner, value = _shares(part.column("text"))
                keys, which = np.unique(owner * HASHED + at, return_inverse=True)
                sums = np.bincount(which, value, len(keys))
                ends = np.searchsorted(keys, np.arange(part.num_rows + 1) * HASHED)
                lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)) for x in ((keys % HASHED).astype(np.int32), sums.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([part.column("pattern"), part.column("times"), *lists], ["pattern", "times", "at", "value"])

    rows = sample.drop("__same").mapInArrow(merge, "pattern int, times long, at array<int>, value array<float>").toArrow()
    at, value = (np.asarray(rows[c].combine_chunks().flatten()) if rows.num_rows else np.zeros(0, np.int32) for c in ("at", "value"))
    sizes = np.asarray(pa.compute.list_value_length(rows["at"]), np.int64)
    row, _ = segments(sizes)
    return at, row.astype(np.int32), value, np.array([posteriors[p] for p in rows["pattern"].to_pylist()]), np.array(rows["times"].to_pylist(), float)


def score_quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, posterior, score, kept``.

    ``posterior`` is the labellers' and ``score`` the linear model's probability
    that a document is good; it is kept at ``KEEP`` or more. A missing text counts
    as empty: it gets no vote and no feature. An empty table gives no rows.
    """
    marked = docs.select(col(key).alias("__id"), col(text).alias("__text"), vote_pattern(text).alias("pattern"), F.xxhash64(col(key), col(text)).alias("__same"))
    same = saved(marked.groupBy("__same", "pattern").agg(F.count("*").alias("n")), "counts")
    counted = same.groupBy("pattern").agg(F.sum("n").alias("n")).collect()  # at most 3 ** 10 patterns
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    counts = np.array([r["n"] for r in counted], float)
    order = np.argsort(patterns)
    posterior, _, _ = fit_labellers(patterns[order], counts[order])
    known = dict(zip(patterns[order].tolist(), posterior.tolist()))
    at, row, value, target, times = _training_rows(marked, same, known, int(counts.sum()))
    weights, intercept = fit_linear(at, row, value, target, times) if len(target) else (np.zeros(HASHED), 0.0)
    table = docs.sparkSession.createDataFrame(list(known.items()), "pattern int, posterior double")
    scored = marked.join(F.broadcast(table), "pattern").select(
        F.col("__id").alias(key), "posterior", linear_score(weights, intercept, "__text").alias("score")
    )
    return scored.withColumn("kept", F.col("score") >= KEEP)
