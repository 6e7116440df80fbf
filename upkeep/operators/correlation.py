"""Pearson correlations of many columns from one reading, pairwise complete.

A task turns its Arrow batches into matrices: with values x (missing ones zero) and presence m it adds up m'm, x'm, (x*x)'m
and x'x.  These hold, for every pair, the count and the sums over the rows where both are present.  The tasks' sums are added
by a map-side combined aggregate, of which each pair is one row; no expression grows with the number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import finite, quoted

_SUMS = ("n", "sum_a", "sum_b", "square_a", "square_b", "product")


def pair_sums(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``a``, ``b`` (positions, a <= b) and the sums over rows where both values are present and finite.

    Values are taken relative to those of one row, so that squares of large, nearly equal values keep their digits.
    """
    values = df.select(*[finite(quoted(name)).alias(f"v{i}") for i, name in enumerate(names)])
    first = values.head()
    pivot = np.array([0.0 if first is None or v is None else v for v in (first or [None] * len(names))])
    size = len(names)
    upper = np.triu_indices(size)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, sums, squares, products = (np.zeros((size, size)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            present = ~np.isnan(x)
            x, m = np.where(present, x - pivot, 0.0), present.astype(np.float64)
            both += m.T @ m
            sums += x.T @ m
            squares += (x * x).T @ m
            products += x.T @ x
        columns = [upper[0], upper[1], both[upper], sums[upper], sums.T[upper], squares[upper], squares.T[upper], products[upper]]
        kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 6]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", *_SUMS])

    found = values.mapInArrow(work, "a int, b int, " + ", ".join(f"{name} double" for name in _SUMS))
    # Every pair is there even if no task had rows.
    none = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("a"))
    none = none.select("a", F.explode(F.sequence("a", F.lit(size - 1))).alias("b"), *[F.lit(0.0).alias(name) for name in _SUMS])
    return found.unionByName(none).groupBy("a", "b").agg(*[F.sum(name).alias(name) for name in _SUMS])


def correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``feature_a``, ``feature_b``, ``correlation`` of every ordered pair; null where a value does not vary."""
    c = F.col
    spread_a = c("n") * c("square_a") - c("sum_a") * c("sum_a")
    spread_b = c("n") * c("square_b") - c("sum_b") * c("sum_b")
    shared = c("n") * c("product") - c("sum_a") * c("sum_b")
    value = F.when((spread_a > 0) & (spread_b > 0), shared / (F.sqrt(spread_a) * F.sqrt(spread_b)))
    label = F.array(*[F.lit(name) for name in names])
    first, second = F.element_at(label, c("a") + 1), F.element_at(label, c("b") + 1)

    def way(here: Column, there: Column) -> Column:
        return F.struct(here.alias("feature_a"), there.alias("feature_b"), value.alias("correlation"))

    # Both directions come from the one aggregate; a union of it with its mirror image would read the rows twice.
    ways = F.when(c("a") == c("b"), F.array(way(first, second))).otherwise(F.array(way(first, second), way(second, first)))
    return pair_sums(df, names).select(F.inline(ways))
