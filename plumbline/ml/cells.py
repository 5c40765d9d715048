"""Boosted trees of one feature each, grown from counted cells in place of passes over the rows.

The cells of a feature are its bins and, if it has missing values, one cell for them. A
tree on one feature is grown from two numbers per cell: its rows, and the sum of what the trees
before left over. A tree that adds ``v[b]`` to the rows in cell ``b`` of its feature takes
``sum(n[a, b] * v[b])`` from the sum in cell ``a`` of another one, where ``n[a, b]`` are the rows in both cells. So the rows
are read for the bins and for the counts of pairs of cells, and any number of
rounds needs no more of them; every tree is still fitted to all rows.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.running import range_splits, running_totals
from ..plans.storage import fresh_path, remove_folder

MAX_FEATURES = 16  # every row makes an entry per pair of them
MAX_PAIRS = 4_000_000  # pairs of cells that the driver holds, at 16 bytes
NODES_PER_WRITE = 25_000
LEAST_GAIN = 1e-12  # of the sum a split explains; less is rounding


@dataclass
class Bins:
    """Of one feature: its least known value, and the thresholds between its bins (a value equal to one is below it)."""

    least: float
    cuts: np.ndarray

    @property
    def missing(self) -> int:
        """The cell of missing values; the bins come before it."""
        return len(self.cuts) + 1


@dataclass
class Counts:
    """Rows and label sums per cell of each feature, and the rows per pair of cells of two features."""

    rows: list[np.ndarray]
    sums: list[np.ndarray]
    pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Tree:
    """Nodes level by level: a child stands after its parent, and a leaf has no children (-1)."""

    prediction: np.ndarray
    rows: np.ndarray
    sums: np.ndarray
    squares: np.ndarray  # of the cells' means, once per row
    gain: np.ndarray
    left: np.ndarray
    right: np.ndarray
    place: np.ndarray
    threshold: np.ndarray


def bins_of(rows: DataFrame, most: Sequence[int]) -> list[Bins]:
    """Bins of every feature of ``features``, at most so many: one per value, or groups of values with about equal rows."""
    values = rows.select(F.posexplode(vector_to_array("features")).alias("feature", "v")).where(~F.isnan("v"))
    counts = values.groupBy("feature", "v").agg(F.count("*").alias("n")).persist()
    try:
        per_feature = counts.groupBy("feature").agg(F.count("*").alias("different"), F.sum("n").alias("n"))
        found = {r["feature"]: r for r in per_feature.collect()}
        few = [i for i, r in found.items() if r["different"] <= most[i]]
        ends = {i: [] for i in range(len(most))}
        for r in counts.where(F.col("feature").isin(few)).collect():
            ends[r["feature"]].append((r["v"], r["v"]))
        for i in set(found) - set(few):
            own = counts.where(F.col("feature") == i).select("v", "n")
            ranked = running_totals(own, "v", ["n"], range_splits(own, "v"))
            group = F.floor(F.col("n_before") * F.lit(most[i]) / F.lit(found[i]["n"]))
            groups = ranked.groupBy(group).agg(F.min("v").alias("least"), F.max("v").alias("greatest"))
            ends[i] = [(r["least"], r["greatest"]) for r in groups.collect()]
    finally:
        counts.unpersist()
    made = []
    for i in range(len(most)):
        pairs = sorted(ends[i])
        below = np.array([b for _, b in pairs[:-1]], dtype=float)
        above = np.array([a for a, _ in pairs[1:]], dtype=float)
        middle = below / 2 + above / 2
        made.append(Bins(pairs[0][0] if pairs else 0.0, np.where((below <= middle) & (middle < above), middle, below)))
    return made


def can_be_held(bins: Sequence[Bins], rows: int) -> bool:
    """Whether the pairs of cells are few, by the most that so many rows can be in."""
    sizes = [b.missing + 1 for b in bins]
    return sum(min(rows, a * b) for i, a in enumerate(sizes) for b in sizes[i + 1:]) <= MAX_PAIRS


def counted(rows: DataFrame, bins: Sequence[Bins]) -> Counts:
    """One pass over ``features`` and ``label``; what is shuffled and collected are counts of cells."""
    values = vector_to_array("features")
    cells = rows.select("label", *[values[i].alias(f"v_{i}") for i in range(len(bins))])
    cut = [i for i, b in enumerate(bins) if len(b.cuts)]
    if cut:  # below the next number after a threshold is at most the threshold
        edges = [[-math.inf, *np.nextafter(bins[i].cuts, math.inf).tolist(), math.inf] for i in cut]
        cells = Bucketizer(
            splitsArray=edges, inputCols=[f"v_{i}" for i in cut], outputCols=[f"c_{i}" for i in cut], handleInvalid="keep"
        ).transform(cells)
    cell = lambda i: F.col(f"c_{i}").cast("int") if i in cut else F.isnan(f"v_{i}").cast("int")
    wanted = [(i, j) for i in range(len(bins)) for j in range(i, len(bins))]
    each = [F.struct(F.lit(k).alias("k"), cell(i).alias("a"), cell(j).alias("b")) for k, (i, j) in enumerate(wanted)]
    spread = cells.select("label", F.explode(F.array(*each)).alias("at")).select("label", "at.*")
    table = spread.groupBy("k", "a", "b").agg(F.count("*").alias("n"), F.sum("label").alias("s")).toArrow()
    k, a, b, n, s = (table[c].to_numpy() for c in ("k", "a", "b", "n", "s"))
    order = np.lexsort((b, a, k))
    starts = np.searchsorted(k[order], np.arange(len(wanted) + 1))
    out = Counts([], [], {})
    for (i, j), start, end in zip(wanted, starts, starts[1:]):
        at = order[start:end]
        if i == j:
            size = bins[i].missing + 1
            out.rows.append(np.bincount(a[at], n[at], size))
            out.sums.append(np.bincount(a[at], s[at], size))
        else:
            out.pairs[i, j] = a[at].astype(np.int32), b[at].astype(np.int32), n[at].astype(float)
    return out


class Rounds:
    """Trees of one feature each, every one on what the start and the trees before it left over.

    ``low`` are the values that stand for a missing one; ``copies`` are the places of the copies where it stands above all
    values, by feature. ``totals`` adds up, per feature, what the trees give to each cell, to missing values, and
    to values so far below the least that a split parts them from it.
    """

    def __init__(self, counts: Counts, bins: Sequence[Bins], low: Sequence[float], copies: dict[int, int], start: float):
        self.counts, self.bins, self.copies = counts, bins, copies
        self.left_over = [s - start * n for s, n in zip(counts.sums, counts.rows)]
        self.totals = [np.zeros(len(n) + 1) for n in counts.rows]
        self.first = [(least + b.least) / 2 for least, b in zip(low, bins)]  # between a missing value and all others

    def trees(self, order: Iterable[int], step: float, depth: int, least: int) -> Iterable[Tree]:
        left_over = self.left_over
        for i in order:
            tree, values = grown(self.counts.rows[i], left_over[i], depth, least)
            split = tree.left >= 0
            thresholds = np.concatenate([[self.first[i]], self.bins[i].cuts, [0.0]])
            tree.threshold = np.where(split, thresholds[tree.threshold], 0.0)
            tree.place = np.where(split, np.where(tree.place == 1, self.copies.get(i, i), i), -1)
            below = 0
            while tree.left[below] >= 0:
                below = tree.left[below]
            added = step * values
            self.totals[i] += np.append(added, step * tree.prediction[below])
            left_over[i] = left_over[i] - self.counts.rows[i] * added
            for (a, b), (x, y, n) in self.counts.pairs.items():
                if i == a:
                    left_over[b] = left_over[b] - np.bincount(y, n * added[x], len(left_over[b]))
                elif i == b:
                    left_over[a] = left_over[a] - np.bincount(x, n * added[y], len(left_over[a]))
            yield tree

    def sums(self) -> Iterable[Tree]:
        """A tree per feature with the totals as its leaves: their sum is that of all trees so far."""
        for i, total in enumerate(self.totals):
            lost = self.bins[i].missing
            spans = [(-1, lost) if i in self.copies else (0, lost)]  # runs of bins, -1 for missing values and those far below
            made = []
            for lo, hi in spans:
                if hi - lo == 1:
                    made.append((total[lo] if lo >= 0 else 0.0, -1, -1, -1, 0.0))
                    continue
                at = (lo + hi) // 2 if lo >= 0 else 0
                cut = self.bins[i].cuts[at - 1] if at else self.first[i]
                made.append((0.0, len(spans), len(spans) + 1, i, cut))
                spans += [(lo, at), (at, hi)]
            if i in self.copies:  # the leaf of the two is parted by the copy
                at = spans.index((-1, 0))
                made[at] = (0.0, len(made), len(made) + 1, self.copies[i], self.first[i])
                made += [(total[lost + 1], -1, -1, -1, 0.0), (total[lost], -1, -1, -1, 0.0)]
            value, left, right, place, threshold = map(np.array, zip(*made))
            ones = np.ones(len(made))
            yield Tree(value, ones, value, value * value, np.where(left < 0, -1.0, 0.0), left, right, place, threshold)


def grown(rows: np.ndarray, sums: np.ndarray, depth: int, least: int) -> tuple[Tree, np.ndarray]:
    """The regression tree of one feature, and its prediction for every cell.

    The last cell holds the missing values, which a split sends to either side. All nodes of a level are split at once: a
    node is a run of bins, and one of them has the missing values too. Until the caller names them, thresholds
    are numbers of the first bin above, and the place is 1 where missing values go up.
    """
    lost = len(rows) - 1
    upto = lambda v: np.concatenate([[0.0], np.cumsum(v[:lost])])
    means = np.divide(sums, rows, out=np.zeros(len(rows)), where=rows > 0)
    squares = sums * means
    n_upto, s_upto, q_upto = upto(rows), upto(sums), upto(squares)
    lo, hi, has = np.array([0]), np.array([lost]), np.array([rows[lost] > 0])
    levels, size, values = [], 0, np.zeros(len(rows))
    for level in range(depth + 1):
        of = lambda v_upto, v: v_upto[hi] - v_upto[lo] + np.where(has, v[lost], 0.0)
        n, s, q = of(n_upto, rows), of(s_upto, sums), of(q_upto, squares)
        left, right, gain = np.full(len(lo), -1), np.full(len(lo), -1), np.full(len(lo), -1.0)
        place, bin_above = np.zeros(len(lo), dtype=int), np.zeros(len(lo), dtype=int)
        levels.append(Tree(s / n, n, s, q, gain, left, right, place, bin_above))
        size += len(lo)
        able = np.flatnonzero((hi - lo + has >= 2) & (n >= 2 * least)) if level < depth else np.array([], dtype=int)
        if len(able):
            best, cut, up = _best_cuts(
                n_upto, s_upto, rows[lost], sums[lost], lo[able], hi[able], has[able], n[able], s[able], least
            )
            more = best - s[able] ** 2 / n[able]
            good = more > LEAST_GAIN * best
            able, cut, up = able[good], cut[good], up[good]
            gain[able] = more[good] / n[able]
            left[able] = size + 2 * np.arange(len(able))
            right[able] = left[able] + 1
            place[able], bin_above[able] = up, cut
        leaf = left < 0
        runs = hi[leaf] - lo[leaf]
        at = np.repeat(lo[leaf] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        values[at] = np.repeat((s / n)[leaf], runs)
        values[lost] = (s / n)[leaf & has].sum() if (leaf & has).any() else values[lost]
        if not len(able):
            break
        both = lambda a, b: np.stack([a, b], axis=1).ravel()
        has = both(has[able] & ~up, has[able] & up)
        lo, hi = both(lo[able], cut), both(cut, hi[able])
    whole = [np.concatenate([getattr(t, f) for t in levels]) for f in Tree.__dataclass_fields__]
    return Tree(*whole), values


def _best_cuts(n_upto, s_upto, n_lost, s_lost, lo, hi, has, n, s, least):
    """Per node the best sum explained, the first bin above the cut, and whether missing values go up; of equals the first."""

    def explained(node, cut, up):
        below = has[node] & np.logical_not(up)
        nl = n_upto[cut] - n_upto[lo[node]] + np.where(below, n_lost, 0.0)
        sl = s_upto[cut] - s_upto[lo[node]] + np.where(below, s_lost, 0.0)
        nr, sr = n[node] - nl, s[node] - sl
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where((nl >= least) & (nr >= least), sl * sl / nl + sr * sr / nr, -np.inf)

    first = lo + 1 - has  # missing values alone can be below
    sizes = hi - first
    starts = np.cumsum(sizes) - sizes
    node = np.repeat(np.arange(len(lo)), sizes)
    cut = first[node] + np.arange(len(node)) - starts[node]
    scores = explained(node, cut, False)
    best = np.maximum.reduceat(scores, starts)
    at = np.minimum.reduceat(np.where(scores == best[node], np.arange(len(node)), len(node)), starts)
    found, up = cut[at], np.zeros(len(lo), dtype=bool)
    for q in np.flatnonzero(has):  # one node at most
        cuts = np.arange(lo[q] + 1, hi[q])
        if len(cuts):
            scores = explained(np.full(len(cuts), q), cuts, True)
            if scores.max() > best[q]:
                best[q], found[q], up[q] = scores.max(), cuts[scores.argmax()], True
    return best, found, up


class SummedTrees(GBTRegressionModel):
    """MLlib's model of trees of one feature each; it scores rows by ``summed``, a tree per feature that adds them up.

    Saved and loaded it is MLlib's model, which asks every tree.
    """

    summed: GBTRegressionModel

    @property
    def trees(self) -> list[DecisionTreeRegressionModel]:
        """Not cached: a cached one is made whenever Spark lists the parameters of the model."""
        return [DecisionTreeRegressionModel(t) for t in self._call_java("trees")]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.getLeafCol():
            return super()._transform(dataset)
        summed = self.summed.copy().setFeaturesCol(self.getFeaturesCol()).setPredictionCol(self.getPredictionCol())
        return summed.transform(dataset)


def as_model(
    kind: type[GBTRegressionModel], one: GBTRegressionModel, spark: SparkSession, trees: Iterable[Tree], width: int,
    step: float, seed: int, **params: int,
) -> GBTRegressionModel:
    """An MLlib model of the only tree of ``one`` and of ``trees``, by way of the form in which MLlib saves models.

    A tree has the ``params`` of its learner. The impurity of a node is that of its cells' means. Nodes are written in parts.
    """
    path = fresh_path(spark, "boosted")
    saved, made = f"{path}/one", f"{path}/all"
    try:
        one.save(saved)
        nodes, listed = spark.read.parquet(f"{saved}/data"), spark.read.parquet(f"{saved}/treesMetadata")
        nodes.write.parquet(f"{made}/data")
        rows, part, held = [tuple(listed.first())], [], 0
        form = json.loads(rows[0][1])
        for i, tree in enumerate(trees):
            params_of = form["paramMap"] | params | {"seed": seed + i}
            rows.append((i + 1, json.dumps(form | {"uid": f"{form['uid']}_{i + 1}", "paramMap": params_of}), float(step)))
            part.append((i + 1, tree))
            held += len(tree.rows)
            if held >= NODES_PER_WRITE:
                _node_rows(spark, part, nodes).write.mode("append").parquet(f"{made}/data")
                part, held = [], 0
        if part:
            _node_rows(spark, part, nodes).write.mode("append").parquet(f"{made}/data")
        spark.createDataFrame(rows, listed.schema).write.parquet(f"{made}/treesMetadata")
        whole = json.loads(spark.read.text(f"{saved}/metadata").first()[0])
        whole |= {"uid": f"boosted_{uuid.uuid4().hex[:12]}", "numTrees": len(rows), "numFeatures": width}
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{made}/metadata")
        package = spark.sparkContext._jvm.org.apache.spark.ml.regression
        return kind(package.GBTRegressionModel.load(made)).setFeaturesCol(one.getFeaturesCol())
    finally:
        remove_folder(spark, path)


def _node_rows(spark: SparkSession, part: Sequence[tuple[int, Tree]], nodes: DataFrame) -> DataFrame:
    joined = {f: np.concatenate([getattr(t, f) for _, t in part]) for f in Tree.__dataclass_fields__}
    sizes = [len(t.rows) for _, t in part]
    table = pa.table({
        "tree": np.repeat([i for i, _ in part], sizes), "id": np.concatenate([np.arange(n) for n in sizes]),
        "impurity": np.maximum(joined["squares"] / joined["rows"] - joined["prediction"] ** 2, 0.0), **joined,
    })
    inner = F.col("left") >= 0
    split = F.struct(
        F.col("place").cast("int").alias("featureIndex"),
        F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        F.col("id").cast("int").alias("id"), "prediction", "impurity",
        F.array("rows", "sums", "squares").alias("impurityStats"), F.col("rows").cast("long").alias("rawCount"), "gain",
        F.col("left").cast("int").alias("leftChild"), F.col("right").cast("int").alias("rightChild"), split.alias("split"),
    )
    rows = spark.createDataFrame(table)
    return rows.select(F.col("tree").cast("int").alias("treeID"), node.alias("nodeData")).to(nodes.schema)
