"""Ordered per-key work that survives hot keys.

A window over ``partitionBy(key)`` sends every row of one key to one task.  When a single asset holds a third
of the table that task never ends.  So the rows per key are counted first (a narrow, map-side combined pass):

* no hot key - the plain window plan, partitioned by the key;
* hot keys - their order range is cut into slices, and the window runs over ``(key, _slice)``.

What crosses a slice border is repaired in one of two ways, both over hot keys only:

* *halo* - a few neighbouring rows are copied into the next slice (ROWS frames of known width);
* *carry* - one summary row per slice is accumulated over the slices (running totals, next match).

Sizes: a key is hot when it has more than ``cut = max(rows_per_slice, rows / max_slices)`` rows.  There are at
most ``max_slices`` hot keys and at most ``2 * max_slices`` slices, whatever the size of the input, which is the
bound behind each ``broadcast`` and ``collect`` in this module.  Split points only steer the distribution: they
come from a hash sample of the hot keys, and no result depends on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec, functions as F, types as T

from ..functions.expressions import none_null

SLICE = "_slice"
HOT = "_hot"
GHOST = "_ghost"
_CUTS = "_cuts"
_SLICES = "_slices"
_CHUNK = 64


@dataclass(frozen=True)
class SlicePolicy:
    """How many rows one task may sort for one key, and how many slices may exist in total."""

    rows_per_slice: int = 2_000_000
    max_slices: int = 10_000
    samples_per_slice: int = 50


DEFAULT_POLICY = SlicePolicy()


def _position(order: Sequence[str]) -> Column:
    """Comparable order position, ascending with nulls last."""
    fields = []
    for name in order:
        fields += [F.col(name).isNull().alias(f"{name}_missing"), F.col(name)]
    return F.struct(*fields)


@dataclass(frozen=True)
class Sliced:
    """Rows ready for ordered work; with hot keys also ``_slice`` and ``_hot`` columns and the hot-key table."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot_keys: DataFrame | None = None

    @property
    def is_split(self) -> bool:
        return self.hot_keys is not None

    @property
    def slice_keys(self) -> list[str]:
        return [*self.keys, SLICE] if self.is_split else list(self.keys)

    def ordering(self, descending: bool = False) -> list[Column]:
        if descending:
            return [F.col(name).desc_nulls_first() for name in self.order]
        return [F.col(name).asc_nulls_last() for name in self.order]

    def window(self, descending: bool = False) -> WindowSpec:
        return Window.partitionBy(*self.slice_keys).orderBy(*self.ordering(descending))

    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.slice_keys)

    def hot_rows(self) -> DataFrame:
        return self.rows.where(F.col(HOT))

    def carry(self, aggregates: dict[str, Column]) -> DataFrame:
        """One summary row per slice of every hot key: at most ``2 * max_slices`` rows."""
        return self.hot_rows().groupBy(*self.slice_keys).agg(
            *[aggregate.alias(name) for name, aggregate in aggregates.items()]
        )

    def across_slices(self) -> WindowSpec:
        """Order of the slices of one key; only for the bounded carry tables."""
        return Window.partitionBy(*self.keys).orderBy(SLICE)

    def attach_carry(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(carry), self.slice_keys, "left")

    def per_slice(self, statistics: DataFrame) -> DataFrame:
        """Replicate per-key rows onto every slice of the key (the small side of a salted join)."""
        if not self.is_split:
            return statistics
        last = F.coalesce(F.col(_SLICES) - 1, F.lit(0)).cast("long")
        return (
            statistics.join(F.broadcast(self.hot_keys.select(*self.keys, _SLICES)), list(self.keys), "left")
            .withColumn(SLICE, F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .drop(_SLICES)
        )

    def join_statistics(self, rows: DataFrame, statistics: DataFrame, how: str = "left") -> DataFrame:
        """Join one-row-per-key ``statistics`` on ``(key, _slice)``, the partitioning the windows already use."""
        return rows.join(self.per_slice(statistics), self.slice_keys, how)

    def with_halo(self, carried: Sequence[str], before: int = 0, after: int = 0) -> DataFrame:
        """Copy the last ``before`` / first ``after`` rows around each slice border into the slice.

        Copies are marked ``_ghost``; drop them after the window.  ``before`` / ``after`` are frame widths known
        at plan time, and the row-number filters run as window group limits before the shuffle.
        """
        payload = [*self.order, *[name for name in carried if name not in self.order and name not in self.keys]]
        if not self.is_split:
            return self.rows
        rows = self.rows.withColumn(GHOST, F.lit(False))
        for count, backward in ((before, True), (after, False)):
            if count:
                ghosts = self._border_rows(payload, count, backward).withColumn(GHOST, F.lit(True))
                rows = rows.unionByName(ghosts, allowMissingColumns=True)
        return rows

    def _border_rows(self, payload: list[str], count: int, backward: bool) -> DataFrame:
        rank, copies = "_rank", "_copies"
        edge = self.window(descending=backward)
        border = (
            self.hot_rows()
            .select(*self.slice_keys, *payload)
            .withColumn(rank, F.row_number().over(edge))
            .where(F.col(rank) <= count)
        )
        # Bounded from here on: at most `count` rows per slice of a hot key.
        forward = Window.partitionBy(*self.keys).orderBy(
            F.col(SLICE) if backward else F.col(SLICE).desc(), *self.ordering(descending=not backward)
        )
        by_slice = Window.partitionBy(*self.keys).orderBy(F.col(SLICE) if backward else F.col(SLICE).desc())
        return (
            border.withColumn(
                copies, F.collect_list(F.struct(*payload)).over(forward.rowsBetween(-(count - 1), Window.currentRow))
            )
            .where(F.col(rank) == 1)
            .withColumn(SLICE, F.lead(SLICE).over(by_slice))
            .where(F.col(SLICE).isNotNull())
            .select(*self.slice_keys, F.inline(copies))
        )


def _count_rows(df: DataFrame, keys: Sequence[str], policy: SlicePolicy) -> tuple[list[Row], int, int]:
    """(hot keys with their row counts, cut, rows without a key); at most ``max_slices`` + 1 rows are collected."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_n")).scalar()
    cut = F.greatest(F.lit(policy.rows_per_slice).cast("long"), F.ceil(total / F.lit(float(policy.max_slices))))
    large = counts.withColumn("_cut", cut).where(F.col("_n") > F.col("_cut")).collect()
    hot = [row for row in large if None not in [row[key] for key in keys]]
    missing = sum(row["_n"] for row in large if None in [row[key] for key in keys])
    return hot, (large[0]["_cut"] if large else policy.rows_per_slice), missing


def _split_points(df: DataFrame, hot: DataFrame, keys: list[str], order: list[str], one_in: int) -> DataFrame:
    """Per hot key, nested arrays of ascending split positions (two levels keep the lookup short)."""
    sampled = (
        df.join(F.broadcast(hot), keys)
        .where(F.pmod(F.xxhash64(*keys, *order), F.lit(one_in)) == 0)
        .groupBy(*keys, _SLICES)
        .agg(F.sort_array(F.collect_list(_position(order))).alias("_sample"))
    )
    size = F.size("_sample")
    points = F.transform(
        F.sequence(F.lit(1), (F.col(_SLICES) - 1).cast("int")),
        lambda i: F.element_at("_sample", (F.floor(i * size / F.col(_SLICES)) + 1).cast("int")),
    )
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_points") - 1) / _CHUNK).cast("int")),
        lambda i: F.slice("_points", i * _CHUNK + 1, F.lit(_CHUNK)),
    )
    return sampled.withColumn("_points", points).select(*keys, _SLICES, chunks.alias(_CUTS))


@dataclass(frozen=True)
class SlicePlan:
    """Measured once, applicable to any frame with the same keys and order columns."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: DataFrame | None
    scatter: int

    def apply(self, df: DataFrame) -> Sliced:
        """Add ``_slice`` where needed so that no window group is unbounded."""
        if self.split is None:
            return Sliced(df, self.keys, self.order)
        position = _position(self.order)
        chunk = F.size(F.filter(_CUTS, lambda points: F.element_at(points, 1) <= position))
        inner = F.size(F.filter(F.element_at(_CUTS, F.greatest(chunk, F.lit(1))), lambda point: point <= position))
        number = (
            F.when(~none_null(self.keys), F.pmod(F.xxhash64(*self.order), F.lit(self.scatter)))
            .when(F.col(_CUTS).isNull() | (chunk == 0), F.lit(0))
            .otherwise((chunk - 1) * _CHUNK + inner)
        )
        rows = (
            df.join(F.broadcast(self.split.select(*self.keys, _CUTS)), list(self.keys), "left")
            .withColumn(SLICE, number.cast("long"))
            .withColumn(HOT, F.col(_CUTS).isNotNull())
            .drop(_CUTS)
        )
        return Sliced(rows, self.keys, self.order, self.split.select(*self.keys, _SLICES))


def plan_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], policy: SlicePolicy = DEFAULT_POLICY
) -> SlicePlan:
    """Count the rows per key and choose the split points of the hot ones (a job on keys and order only).

    ``order`` names ascending columns (nulls last) that identify a row within its key.  Rows with a missing key
    belong to no group; many of them are scattered, and the caller masks their results.
    """
    keys, order = list(keys), list(order)
    source = df.select(*dict.fromkeys([*keys, *order]))
    hot, cut, missing = _count_rows(source, keys, policy)
    if not hot and not missing:
        return SlicePlan(tuple(keys), tuple(order), None, 1)
    schema = T.StructType([*[source.schema[key] for key in keys], T.StructField(_SLICES, T.LongType())])
    table = df.sparkSession.createDataFrame([(*[row[k] for k in keys], -(-row["_n"] // cut)) for row in hot], schema)
    split = _split_points(source, table, keys, order, max(1, cut // policy.samples_per_slice))
    # At most 2 * max_slices positions: kept on the driver, so that every use sees the same split.
    found = split.collect()
    return SlicePlan(
        tuple(keys), tuple(order), df.sparkSession.createDataFrame(found, split.schema), max(1, -(-missing // cut))
    )


def slice_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], policy: SlicePolicy = DEFAULT_POLICY
) -> Sliced:
    return plan_slices(df, keys, order, policy).apply(df)
