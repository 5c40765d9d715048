"""Nearest neighbours through low-dimensional stable projections and kd-trees.

Gaussian projections turn a distance d into d times the root of a chi-square
variable with as many degrees of freedom as projections. Vectors are dealt into
blocks; each block keeps its projections in a kd-tree. For a query the leaves
are visited in the order of their projected distance, and all their vectors are
verified on the original coordinates. The search ends when an unseen vector as
near as the k-th best would, with probability ``CONFIDENCE``, have been projected
to within the distance already searched. So each true neighbour is missed with
a probability of at most 1 - ``CONFIDENCE``.

Queries meet every block, in blocks of their own: neither a task's vectors nor
its queries grow with the table. The per-block results are merged by rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col
from .common import saved

PROJECTIONS = 8  # even, so that the chi-square distribution has a closed form
CONFIDENCE = 0.98
LEAF = 64
BLOCK = 16_384
QUERY_BLOCK = 2_048
SEED = 7


def chi_square_below(x: np.ndarray, degrees: int = PROJECTIONS) -> np.ndarray:
    """Probability that a chi-square variable with an even number of degrees of freedom is at most x."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def projection(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, PROJECTIONS))


class ProjectedTree:
    """Leaves of a kd-tree over projected vectors: rows, and the corners of their boxes."""

    def __init__(self, points: np.ndarray):
        self.leaves, stack = [], [np.arange(len(points))]
        while stack:
            rows = stack.pop()
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                continue
            own = points[rows]
            axis = int(np.argmax(own.max(0) - own.min(0)))
            order = np.argpartition(own[:, axis], len(rows) // 2)
            stack += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        self.low = np.array([points[r].min(0) for r in self.leaves])
        self.high = np.array([points[r].max(0) for r in self.leaves])

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of every query to every leaf's box."""
        out = np.zeros((len(queries), len(self.leaves)))
        for axis in range(queries.shape[1]):
            q = queries[:, axis : axis + 1]
            out += np.maximum(np.maximum(self.low[:, axis] - q, q - self.high[:, axis]), 0) ** 2
        return out


def search_block(vectors, ids, rows, queries, query_rows, k: int):
    """``(query_row, vec_id, row, distance)`` of the k nearest found in one block, per query."""
    matrix = projection(vectors.shape[1])
    tree = ProjectedTree(vectors @ matrix)
    boxes = tree.distances(queries @ matrix)
    out = []
    for q in range(len(queries)):
        order = np.argsort(boxes[q], kind="stable")
        near = boxes[q][order]
        seen, squares, at, step = [], np.zeros(0), 0, 2
        while at < len(order):
            if len(squares) >= k:
                best = np.partition(squares, k - 1)[k - 1]
                reached = near[at]
                if reached > 0 and (best == 0 or chi_square_below(np.array(reached / best)) >= CONFIDENCE):
                    break
            found = np.concatenate([tree.leaves[i] for i in order[at : at + step]])
            found = found[rows[found] != query_rows[q]]
            at, step = at + step, min(step * 2, 16)
            seen.append(found)
            squares = np.concatenate([squares, ((vectors[found] - queries[q]) ** 2).sum(axis=1)])
        found = np.concatenate(seen) if seen else np.zeros(0, np.int64)
        best = np.lexsort((rows[found], ids[found], squares))[:k]
        out.append((np.full(len(best), query_rows[q]), ids[found[best]], rows[found[best]], np.sqrt(squares[best])))
    return [np.concatenate(x) for x in zip(*out)]


def usable(vector: str) -> Column:
    """A vector takes part if all its components are finite and one is not 0."""
    number = lambda x: x.cast("double")
    finite = F.forall(col(vector), lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))
    return col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(col(vector), lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows that ``queries`` selects, the k nearest other rows.

    Score is the Euclidean distance in double precision; ties go to the smaller
    key. Only vectors of the same length are compared. Vectors that are missing,
    zero or not finite, and rows without a key, take no part. A repeated row is
    another row. An empty table gives no rows.
    """
    rows = vectors.select(
        col(key).cast("long").alias("id"), col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    ).where(usable("v") & F.col("id").isNotNull())
    rows = saved(rows.withColumns({"row": F.monotonically_increasing_id(), "size": F.size("v")}), "vectors")
    n = rows.agg(F.count("*").alias("all"), F.count_if("asks").alias("asks")).first()
    blocks, query_blocks = max(1, -(-n["all"] // block)), max(1, -(-n["asks"] // query_block))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    group = lambda salt, count: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(count)).cast("int")
    data = rows.select("size", "id", "row", "v", group(1, blocks).alias("block"), every(query_blocks).alias("part"))
    asked = rows.where("asks").select("size", "row", "v", every(blocks).alias("block"), group(2, query_blocks).alias("part"))
    keys = ["size", "block", "part"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        if left.num_rows and right.num_rows:
            matrix = lambda t: np.asarray(t["v"].combine_chunks().flatten()).reshape(t.num_rows, -1)
            numbers = lambda t, c: np.asarray(t[c].combine_chunks())
            out = search_block(matrix(left), numbers(left, "id"), numbers(left, "row"), matrix(right), numbers(right, "row"), k)
        return pa.table(dict(zip(("query_row", "id", "row", "score"), map(pa.array, out))))

    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        search, "query_row long, id long, row long, score double"
    )
    order = Window.partitionBy("query_row").orderBy("score", "id", "row")  # at most k rows per block
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = rows.where("asks").select(F.col("row").alias("query_row"), F.col("id").alias("query_id"))
    return ranked.join(names, "query_row").select("query_id", "rank", F.col("id").alias(key), "score")
