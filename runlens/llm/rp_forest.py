"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample: a node's plane lies between two sampled
vectors, at the median.  Every vector is indexed in a leaf of each tree.  A query goes down
all trees with one priority queue, so the forest's leaves are visited by how
far the query lies beyond the planes on the way, whatever tree they are in.
Queries meet the rows of their leaves in blocks of bounded size, the best of
each block are merged, and the nearest are ranked anew by the exact cosine.

Of equal vectors only as many as can be an answer are indexed, and equal queries
are searched once.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.plans.tables import write_table

# Bound of the sample that planes are fitted on, and of a tree's depth.
SAMPLE_ROWS = 16_384
MAX_DEPTH = 10
TREES = 12
LEAF_ROWS = 400
# Leaves of the forest that a query visits, however many there are.
VISITED = 160
# Most rows and most queries of a block.
BLOCK_ROWS = 4_096


@dataclass
class Forest:
    """``planes[t]``: one row for each inner node of tree t in level order; ``cuts`` likewise."""

    depth: int
    planes: np.ndarray
    cuts: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, depth: int, trees: int, seed: int = 5) -> Forest:
        rng = np.random.default_rng(seed)
        planes, cuts = np.zeros((trees, 2 ** depth - 1, x.shape[1])), np.zeros((trees, 2 ** depth - 1))
        for t in range(trees):
            at = np.zeros(len(x), np.int64)
            for node in range(2 ** depth - 1):
                own = np.flatnonzero(at == node)
                w = rng.normal(size=x.shape[1])
                if len(own) > 1:
                    i, j = rng.choice(own, 2, replace=False)
                    if (x[i] != x[j]).any():
                        w = x[i] - x[j]
                w = w / np.linalg.norm(w)
                side = x[own] @ w
                planes[t, node], cuts[t, node] = w, np.median(side) if len(own) else 0.0
                at[own] = 2 * node + 1 + (side > cuts[t, node])
        return cls(depth, planes, cuts)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every vector in every tree."""
        out = np.empty((len(x), len(self.planes)), np.int32)
        for t in range(len(self.planes)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                side = np.einsum("nd,nd->n", x, self.planes[t][at]) - self.cuts[t][at]
                at = 2 * at + 1 + (side > 0)
            out[:, t] = at - (2 ** self.depth - 1)
        return out

    def visit(self, q: np.ndarray, n: int) -> list[tuple[int, int]]:
        """The ``n`` (tree, leaf) nearest to a query: least sum of squared distances beyond planes."""
        sides = self.planes @ q - self.cuts
        queue, out, inner = [(0.0, t, 0) for t in range(len(self.planes))], [], 2 ** self.depth - 1
        while queue and len(out) < n:
            beyond, t, node = heapq.heappop(queue)
            while node < inner:
                s = sides[t, node]
                heapq.heappush(queue, (beyond + s * s, t, 2 * node + 1 + int(s <= 0)))
                node = 2 * node + 1 + int(s > 0)
            out.append((t, node - inner))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(v: Column) -> Column:
    """Not NULL or empty, all components finite, not all zero."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda c: c != 0)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, visited: int = VISITED) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found for
    every row of ``vectors`` (vec_id, embedding) that ``is_query`` marks.

    Nearest first by cosine, ties to the smaller vec_id; a query's own vec_id is
    no answer.  A vector that is NULL, empty or zero, or holds a NULL or non-finite component,
    takes no part, nor does a NULL vec_id.  Of vectors of unlike length the
    shorter ones end in zeros, which changes no cosine.  Repeated rows count
    once.  Other columns are ignored; without a query or other vector there is no row.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"), is_query.alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    width = rows.agg(F.max(F.size("v")).alias("width")).first().width
    if width is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))))
    # Of equal vectors, the k + 1 of smallest id hold every answer.
    same = Window.partitionBy("v").orderBy("vec_id")
    index = write_table(rows.select("vec_id", "v").withColumn("_n", F.dense_rank().over(same)).where(F.col("_n") <= k + 1)
                        .drop("_n").dropDuplicates(["vec_id", "v"]), "vectors")
    queries = rows.where("is_query").select("vec_id", "v")
    asked = write_table(queries.groupBy("v").agg(F.min("vec_id").alias("rep")), "queries")
    n = index.count()
    depth = int(min(MAX_DEPTH, max(1, np.ceil(np.log2(max(n, 2) / LEAF_ROWS)))))
    sample = index.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toArrow()["v"].combine_chunks()
    forest = vectors.sparkSession.sparkContext.broadcast(Forest.fit(_unit(_matrix(sample)), depth, trees))
    probes = min(max(trees, visited), trees * 2 ** depth)

    def place(batches):
        for batch in batches:
            at = forest.value.leaves(_unit(_matrix(batch.column("v"))))
            who, t = np.divmod(np.arange(at.size), at.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(who)), batch.column("v").take(pa.array(who)),
                                              pa.array((t * 2 ** depth + at.ravel()).astype(np.int32))], ["vec_id", "v", "leaf"])

    def search(batches):
        for batch in batches:
            units = _unit(_matrix(batch.column("v")))
            leaves = [[t * 2 ** depth + leaf for t, leaf in forest.value.visit(q, probes)] for q in units]
            who = pa.array(np.repeat(np.arange(len(leaves)), [len(x) for x in leaves]))
            yield pa.RecordBatch.from_arrays([batch.column("rep").take(who), batch.column("v").take(who),
                                              pa.array([x for own in leaves for x in own], pa.int32())], ["rep", "v", "leaf"])

    placed = index.mapInArrow(place, "vec_id bigint, v array<double>, leaf int")
    sought = write_table(asked.mapInArrow(search, "rep bigint, v array<double>, leaf int"), "visits")

    def blocks(side: DataFrame, name: str) -> DataFrame:
        """Blocks of each leaf: at most TREES * 2 ** MAX_DEPTH rows."""
        return side.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias(name))

    placed = write_table(placed, "leaves")
    # One row a leaf, so the side is bounded by the size of the forest.
    cut = F.broadcast(blocks(placed, "n_rows").join(blocks(sought, "n_queries"), "leaf"))
    every = lambda n_blocks: F.explode(F.sequence(F.lit(0), F.col(n_blocks) - 1))
    own = lambda column, n_blocks: F.pmod(F.xxhash64(column), F.col(n_blocks)).cast("int")
    left = placed.join(cut, "leaf").select("leaf", own("vec_id", "n_rows").alias("row_block"), every("n_queries").alias("query_block"), "vec_id", "v")
    right = sought.join(cut, "leaf").select("leaf", every("n_rows").alias("row_block"), own("rep", "n_queries").alias("query_block"), "rep", "v")

    def best(rows: pa.Table, asks: pa.Table) -> pa.Table:
        names = ["rep", "vec_id", "near"]
        if not (rows.num_rows and asks.num_rows):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names)
        ids = rows["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], _unit(_matrix(rows["v"].combine_chunks()))[order]
        # Rounded, so that equal vectors tie and the smaller id goes first.
        scores = np.round(_unit(_matrix(asks["v"].combine_chunks())) @ x.T, 12)
        top = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
        return pa.table([pa.array(np.repeat(asks["rep"].to_numpy(), top.shape[1])), pa.array(ids[top].ravel()),
                         pa.array(np.take_along_axis(scores, top, 1).ravel())], names)

    keys = ["leaf", "row_block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "rep bigint, vec_id bigint, near double")
    # Two more than can be an answer, should rounding have changed the order.
    near = Window.partitionBy("rep").orderBy(F.desc("near"), "vec_id")
    found = (found.groupBy("rep", "vec_id").agg(F.max("near").alias("near"))
             .withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= k + 3).select("rep", "vec_id"))
    found = write_table(found, "found")
    exact = (found.join(asked.withColumnRenamed("v", "_q"), "rep").join(index, "vec_id")
             .select("rep", "vec_id", cosine(F.col("_q"), F.col("v")).alias("score")))
    of_query = queries.distinct().join(asked, "v").select(F.col("vec_id").alias("query_id"), "rep")
    ranked = of_query.join(exact, "rep").where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A vec_id with several vectors answers by its nearest.
    ranked = ranked.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
