"""Exact top-k search by integer inner product: MaxScore over posting lists per shard, shards merged.

A vector component becomes ``floor(1024 * x)``.  A dimension is a term; a shard keeps for every dimension one list of its
rows with a positive and one with a negative value.  For a query the list of the sign that its own component has adds to
scores and has a bound (|component| times the largest value of the list); the other sign only lowers scores, bound zero.
Rows are worked on in segments, each with its own lists and bounds, and the k-th best score so far is the threshold:

* terms in order of their bounds; those at the end whose bounds sum to less than the threshold are non-essential, because
  a row that is in none of the essential lists can't reach the threshold;
* the essential lists are traversed and their products added up;
* the rows found there are probed for what is left (values of the wrong sign, then the non-essential terms), some terms at
  a time, and a row is dropped as soon as its sum and the bounds still to come are below the threshold.

Nothing below the threshold can enter and ties are kept until ids decide, so the result is exact.  Each block of queries
meets each shard in a task of its own (a stated query set against all rows, in blocks); k rows a query leave it, a rank
filter keeps k before the shuffle, and the shards' results are merged.

Defined results: vectors that are null or hold null or non-finite components (also after scaling) take no part, zero and
empty vectors do; vectors of different length are not compared; rows without an id take no part; each row is a
candidate for itself, so repeated rows are repeated results, and is never found by a query of its own id; ties go to the
smaller id; scores beyond 64 bits are worked out exactly and count as the nearest 64-bit number; fewer than k candidates
are all returned; no queries or no rows give no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.support import kept, map_batches, shared_folder, ship_code, spread, stored

SCALE = 1024
#: Values in a shard, rows of a segment, values in a block of queries, terms probed before rows are dropped again.
SHARD_VALUES = 1 << 20
SEGMENT_ROWS = 2048
QUERY_VALUES = 1 << 14
PROBES = 6
SAFE = 2**62


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers (as doubles) in the smallest type that holds them."""
    most = np.abs(values).max(initial=0)
    kind = next((t for t in (np.int16, np.int32) if most <= np.iinfo(t).max), np.int64 if most < SAFE else None)
    return values.astype(kind) if kind else values


def whole_numbers(values: np.ndarray, fits: bool) -> np.ndarray:
    """For exact work: 64-bit integers where all sums fit, else Python's."""
    if fits:
        return values.astype(np.int64)
    flat = np.empty(values.size, dtype=object)
    flat[:] = [int(x) for x in values.ravel().tolist()]
    return flat.reshape(values.shape)


class Segment:
    """Rows of a shard: ids, values by row, and for each dimension and sign the rows that have it and their largest size."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.rows = {(d, up): np.nonzero(c > 0 if up else c < 0)[0].astype(np.uint16) for d, c in enumerate(values.T) for up in (True, False)}
        self.peaks = {key: float(np.abs(values[rows, key[0]].astype(np.float64)).max(initial=0)) for key, rows in self.rows.items()}
        self.peak = max(self.peaks.values(), default=0.0)


class Search:
    """The k best rows of segments for one query; ``offer`` takes the segments one after another."""

    def __init__(self, query_id: int, query: np.ndarray, k: int):
        self.query_id, self.query, self.k = query_id, query, k
        self.score, self.found = np.empty(0, dtype=object), np.empty(0, dtype=np.int64)
        self.probed = 0

    def offer(self, segment: Segment) -> None:
        most = float(np.abs(self.query).max(initial=0)) * segment.peak * max(1, len(self.query))
        fits = most < SAFE
        query = whole_numbers(self.query, fits)
        threshold = self.score[-1] if len(self.score) == self.k else None
        if threshold is None or threshold <= 0:  # also a row that no term favours may be among the best
            rows = np.arange(len(segment.ids))
            sums = (whole_numbers(segment.values, fits) * query).sum(axis=1)
        else:
            rows, sums = self._competitive(segment, query, threshold, fits)
        self._keep(segment.ids[rows], sums, threshold)

    def _competitive(self, segment: Segment, query: np.ndarray, threshold: int, fits: bool) -> tuple[np.ndarray, np.ndarray]:
        kind = np.int64 if fits else object
        terms = [d for d in range(len(query)) if query[d]]
        bounds = {d: abs(int(query[d])) * int(segment.peaks[d, bool(query[d] > 0)]) for d in terms}
        terms.sort(key=lambda d: -bounds[d])
        left, essential = sum(bounds.values()), 0
        while essential < len(terms) and left >= threshold:
            left -= bounds[terms[essential]]
            essential += 1
        total = np.zeros(len(segment.ids), dtype=kind)
        for d in terms[:essential]:
            rows = segment.rows[d, bool(query[d] > 0)]
            total[rows] += whole_numbers(segment.values[rows, d], fits) * query[d]
        rows = np.nonzero((total > 0) & (total + left >= threshold))[0]
        sums = total[rows]
        lowering = sorted(terms[:essential], key=lambda d: -abs(query[d]))
        for start in range(0, len(lowering), PROBES):
            some = lowering[start : start + PROBES]
            products = whole_numbers(segment.values[np.ix_(rows, some)], fits) * query[some]
            sums = sums + np.minimum(products, 0).sum(axis=1)
            self.probed += products.size
            good = sums + left >= threshold
            rows, sums = rows[good], sums[good]
        for start in range(essential, len(terms), PROBES):
            some = terms[start : start + PROBES]
            products = whole_numbers(segment.values[np.ix_(rows, some)], fits) * query[some]
            sums, left = sums + products.sum(axis=1), left - sum(bounds[d] for d in some)
            self.probed += products.size
            good = sums + left >= threshold
            rows, sums = rows[good], sums[good]
        return rows, sums

    def _keep(self, ids: np.ndarray, sums: np.ndarray, threshold) -> None:
        if sums.dtype == object:
            sums = np.array([max(-(2**63), min(2**63 - 1, s)) for s in sums.tolist()], dtype=object)
        good = ids != self.query_id
        if threshold is not None:
            good &= (sums >= threshold).astype(bool)
        elif good.sum() > 4 * self.k and sums.dtype != object:
            good &= sums >= np.partition(sums[good], -self.k)[-self.k]
        score = np.concatenate([self.score, sums[good].astype(object)])
        found = np.concatenate([self.found, ids[good]])
        best = sorted(range(len(score)), key=lambda i: (-score[i], found[i]))[: self.k]
        self.score, self.found = score[best], found[best]


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``v`` array<double> of whole numbers, ``size``; rows that take no part are left out."""
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: x * SCALE)
    rows = df.select(F.col(key).cast("long").alias("id"), scaled.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite).withColumn("size", F.size("v"))


def packed(rows: DataFrame, by: str, values: int, make, folder: str) -> tuple[DataFrame, int]:
    """Rows dealt evenly, whatever their ids, into groups of about ``values`` numbers each; one stored row per group."""
    total = rows.agg(F.sum(F.col("size") + 1)).first()[0] or 0
    groups = max(1, -(-total // values))
    dealt = rows.withColumn(by, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))

    def work(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        ids = table.column("id").to_numpy()
        numbers = np.floor(table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), size)
        order = np.argsort(ids, kind="stable")
        content = pickle.dumps(make(ids[order], narrow(numbers[order])), protocol=5)
        return pa.table({"size": pa.array([size], pa.int32()), by: table.column(by)[:1], "content": pa.array([content], pa.binary())})

    ship_code(rows.sparkSession)
    made = dealt.groupBy("size", by).applyInArrow(work, f"size int, `{by}` int, content binary")
    return stored(made, folder, by), groups


def segments(ids: np.ndarray, values: np.ndarray) -> list[Segment]:
    return [Segment(ids[i : i + SEGMENT_ROWS], values[i : i + SEGMENT_ROWS]) for i in range(0, len(ids), SEGMENT_ROWS)]


def top_products(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_values: int = SHARD_VALUES,
    query_values: int = QUERY_VALUES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k highest inner products of rows of ``df`` for each of ``queries``."""
    folder = shared_folder(df.sparkSession)
    shards, parts = packed(usable(df, key, vector), "shard", shard_values, segments, folder)
    asked, blocks = packed(usable(queries, key, vector), "block", query_values, lambda ids, values: (ids, values), folder)
    # By vector length; either side has one row a group.  Each meeting is a task.
    meetings = shards.withColumnRenamed("content", "rows").join(asked.withColumnRenamed("content", "asked"), "size")
    meetings = spread(meetings.select("size", "shard", "rows", "asked"), parts * blocks)

    def work(batches):
        for batch in batches:
            for size, shard, rows, block in zip(*[batch.column(i) for i in range(4)]):
                name = (folder, size.as_py(), shard.as_py())
                held = kept("shard", dict)  # the last shard of this worker
                if name not in held:
                    held.clear()
                    held[name] = pickle.loads(rows.as_py())
                ids, values = pickle.loads(block.as_py())
                for query_id, query in zip(ids.tolist(), values):
                    search = Search(query_id, query, k)
                    for segment in held[name]:
                        search.offer(segment)
                    columns = [pa.array(x, pa.int64()) for x in ([query_id] * len(search.found), search.found, search.score.tolist())]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    found = map_batches(meetings, work, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
