"""Approximate nearest neighbours: one vantage-point tree per shard, pruned by the triangle inequality.

Vectors are scaled to length one, where the Euclidean distance orders as the cosine does and is a metric.  Each shard of
rows builds a tree: an inner node holds a vantage point and the distance that halves the rest, a leaf holds a block of
vectors.  A block of queries walks a tree together; a branch is skipped for a query if no point in it can come closer than
the k-th found so far by more than ``factor`` allows: with gap g between query and branch, it is skipped if
``g * factor > distance``.  Factor one is exact search; larger factors skip more and may miss neighbours.

Rows are dealt to shards evenly, whatever their ids.  Trees are built once, with their scaled vectors, and stored.  Every
block of queries goes to every tree (a stated query set against all rows, in blocks), each meeting in a task of its own;
only the k best of each query leave it, and a rank filter keeps k of a query before they are shuffled.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; vectors of different
length are not compared; rows that repeat an id take part each for itself, as query and as candidate, and the k best
pairs of an id are returned; of rows that repeat id and vector one takes part; ties go to the smaller id;
fewer than k candidates are all returned; no queries or no rows give no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.support import kept, map_batches, shared_folder, spread, stored

SHARD_ROWS = 16_384
QUERY_BLOCK = 1024
LEAF_ROWS = 128


def rounding(size: int) -> float:
    """Bound on the error of a computed cosine, and of a squared distance ``2 - 2 * cosine``, at this vector length.

    Scaling to length one and the sum of products are off by (2 size + 6) half units in the last place, doubled in the
    squared distance; this is twice that and more.  Of a distance near zero the root makes about 1e-7 of it, so bounds on
    distances are taken from the squares.
    """
    return 4 * (size + 8) * float(np.finfo(np.float64).eps)


def distances(cosine: np.ndarray, error: float = 0.0) -> np.ndarray:
    """Distance of unit vectors with this cosine; with ``error`` (or its negative) no less (no more) than the true one."""
    return np.sqrt(np.maximum(0, 2 - 2 * cosine + error))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by the largest component first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row pair, from the vectors as given, added up component by component: equal vectors tie.

    Scaling by a power of two changes no digit; it keeps squares from overflowing or vanishing.
    """
    a, b = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (a, b))
    ab, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for x, y in zip(a.T, b.T):
        ab += x * y
        aa += x * x
        bb += y * y
    return ab / (np.sqrt(aa) * np.sqrt(bb))


def build(ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS, seed: int = 7) -> dict:
    """Tree over the rows: nodes ``(row of the vantage point, radius, inner, outer)`` or leaves ``(rows,)``.

    The radius is kept as a cosine."""
    draw, points, nodes = np.random.default_rng(seed), unit(vectors), []

    def grow(rows: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(None)
        if len(rows) <= leaf_rows:
            nodes[at] = (rows,)
            return at
        vantage = rows[draw.integers(len(rows))]
        rest = rows[rows != vantage]
        near = points[rest] @ points[vantage]
        order = np.argsort(-near, kind="stable")
        half = len(rest) // 2
        radius = near[order[half]]
        inner, outer = grow(rest[order[:half]]), grow(rest[order[half:]])
        nodes[at] = (vantage, radius, inner, outer)
        return at

    if len(ids):
        grow(np.arange(len(ids)))
    return {"ids": ids, "vectors": vectors, "points": points, "nodes": nodes}


class Search:
    """The k nearest rows of one tree for a block of queries."""

    def __init__(self, tree: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.tree, self.k, self.factor = tree, k, factor
        self.query_ids, self.queries = query_ids, queries
        self.points, self.targets = tree["points"], unit(queries)
        self.error = rounding(queries.shape[1])
        self.score = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        if tree["nodes"]:
            self._visit(0, np.arange(len(queries)))

    def _reach(self, active: np.ndarray) -> np.ndarray:
        """Distance of the k-th found, or a little more; two units have a distance of two at most."""
        return distances(np.maximum(self.score[active, -1], -1), self.error)

    def _offer(self, active: np.ndarray, rows: np.ndarray, near: np.ndarray) -> None:
        ids = self.tree["ids"][rows]
        good = (near >= self.score[active, -1][:, None] - self.error) & (self.query_ids[active][:, None] != ids[None, :])
        where, which = np.nonzero(good)
        if not len(where):
            return
        exact = cosines(self.queries[active[where]], self.tree["vectors"][rows[which]])
        touched, first = np.unique(where, return_index=True)
        for q, a, b in zip(active[touched].tolist(), first, [*first[1:], len(where)]):
            score = np.concatenate([self.score[q], exact[a:b]])
            found = np.concatenate([self.found[q], ids[which[a:b]]])
            best = np.lexsort((found, -score))[: self.k]
            self.score[q], self.found[q] = score[best], found[best]

    def _visit(self, at: int, active: np.ndarray) -> None:
        node = self.tree["nodes"][at]
        if len(node) == 1:
            if len(node[0]):
                self._offer(active, node[0], self.targets[active] @ self.points[node[0]].T)
            return
        vantage, radius, inner, outer = node
        near = self.targets[active] @ self.points[vantage]
        self._offer(active, np.array([vantage]), near[:, None])
        closer = near > radius
        for inside in (True, False):  # each query takes its own side first, then the other if it may hold something nearer
            own, other = (inner, outer) if inside else (outer, inner)
            mine = closer == inside
            if mine.any():
                self._visit(own, active[mine])
                far, here = (radius, near[mine]) if inside else (near[mine], radius)
                gap = distances(far, -self.error) - distances(here, self.error)  # no more than the true one
                wide = gap * self.factor <= self._reach(active[mine])
                if wide.any():
                    self._visit(other, active[mine][wide])


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``v`` array<double>, ``size``; rows that take no part are left out."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    return rows.dropDuplicates(["id", "v"]).withColumn("size", F.size("v"))


def packed(df: DataFrame, by: str, make) -> DataFrame:
    """One row per group ``size``, ``by``: its rows as arrays in one binary."""

    def work(pdf):
        ids, vectors = pdf["id"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.float64)
        order = np.argsort(ids, kind="stable")
        made = pickle.dumps(make(ids[order], vectors[order]), protocol=5)
        return pdf[["size", by]].head(1).assign(content=made)

    return df.groupBy("size", by).applyInPandas(work, f"size int, `{by}` int, content binary")


def index(rows: DataFrame, shards: int, folder: str) -> DataFrame:
    """The stored trees, one row per shard and vector length; every usable row is in one of them."""
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    return stored(packed(rows, "shard", build), folder, "trees")


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest rows of ``df`` for each row of ``queries``."""
    folder = shared_folder(df.sparkSession)
    shards = max(1, -(-df.count() // shard_rows))
    trees = index(usable(df, key, vector), shards, folder)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = usable(queries, key, vector).withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    asked = stored(packed(asked, "block", lambda ids, vectors: (ids, vectors)), folder, "queries")
    meetings = trees.withColumnRenamed("content", "tree").join(asked.withColumnRenamed("content", "asked"), "size")
    meetings = spread(meetings.select("size", "shard", "tree", "asked"), shards * blocks)

    def work(batches):
        for batch in batches:
            for size, shard, tree, block in zip(*[batch.column(i) for i in range(4)]):
                name = (folder, size.as_py(), shard.as_py())
                held = kept("tree", dict)  # the last tree of this worker
                if name not in held:
                    held.clear()
                    held[name] = pickle.loads(tree.as_py())
                query_ids, vectors = pickle.loads(block.as_py())
                search = Search(held[name], query_ids, vectors, k, factor)
                hit = search.score > -np.inf
                asked_by = np.broadcast_to(query_ids[:, None], hit.shape)
                columns = [asked_by[hit], search.found[hit], search.score[hit]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    found = map_batches(meetings, work, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
