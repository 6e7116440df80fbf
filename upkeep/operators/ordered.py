"""Window-shaped operators built on slices: neighbours, rolling frames, running totals, next match."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.expressions import none_null
from .slicing import DEFAULT_POLICY, GHOST, HOT, SLICE, SlicePlan, SlicePolicy, Sliced, slice_rows

_ALL_ROWS = "_all_rows"


def add_row_windows(
    sliced: Sliced,
    outputs: Mapping[str, Callable[[WindowSpec], Column]],
    carried: Sequence[str],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add ROWS-framed columns whose frames lie within ``before`` rows back and ``after`` rows ahead.

    All outputs share one window specification, hence one exchange and one sort.  Rows without a key get NULL.
    """
    spec = sliced.window()
    keyed = none_null(sliced.keys)
    windows = [F.when(keyed, build(spec)).alias(name) for name, build in outputs.items()]
    rows = sliced.with_halo(carried, before, after).select("*", *windows)
    return rows.where(~F.col(GHOST)).drop(GHOST) if sliced.is_split else rows


def with_row_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Callable[[WindowSpec], Column]],
    carried: Sequence[str],
    before: int = 0,
    after: int = 0,
    policy: SlicePolicy = DEFAULT_POLICY,
    plan: SlicePlan | None = None,
) -> DataFrame:
    """:func:`add_row_windows` for one use; ``plan`` is a measurement made before."""
    sliced = plan.apply(df) if plan else slice_rows(df, keys, order, policy)
    return add_row_windows(sliced, outputs, carried, before, after).drop(SLICE, HOT)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str],
    totals: Mapping[str, str] | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
    size: int | None = None,
) -> DataFrame:
    """Cumulative sums per key (``sums``: output -> input) and whole-key sums (``totals``).

    With no key the running total is global, and still runs in parallel once it spans several slices.  ``size`` is the
    number of rows, if known: no key can be hot among fewer rows than a slice has, so then none are counted.
    """
    totals = dict(totals or {})
    grouped = list(keys)
    if not grouped:
        df, grouped = df.withColumn(_ALL_ROWS, F.lit(0)), [_ALL_ROWS]
    cold = size is not None and size <= policy.rows_per_slice
    sliced = Sliced(df, tuple(grouped), tuple(order)) if cold else slice_rows(df, grouped, order, policy)
    up_to_row = sliced.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not sliced.is_split:
        whole = sliced.whole()
        return sliced.rows.select(
            "*",
            *[F.sum(source).over(up_to_row).alias(name) for name, source in sums.items()],
            *[F.sum(source).over(whole).alias(name) for name, source in totals.items()],
        ).drop(_ALL_ROWS)
    earlier = sliced.across_slices().rowsBetween(Window.unboundedPreceding, -1)
    over_key = Window.partitionBy(*grouped)

    inputs = sorted({*sums.values(), *totals.values()})
    carry = sliced.carry({f"_part_{name}": F.sum(name) for name in inputs})
    carry = carry.select(
        *sliced.slice_keys,
        *[F.sum(f"_part_{name}").over(earlier).alias(f"_before_{name}") for name in inputs],
        *[F.sum(f"_part_{name}").over(over_key).alias(f"_whole_{name}") for name in inputs],
    )
    local = sliced.rows.select(
        "*",
        *[F.sum(source).over(up_to_row).alias(f"_run_{name}") for name, source in sums.items()],
        *[F.sum(source).over(sliced.whole()).alias(f"_sum_{name}") for name, source in totals.items()],
    )
    joined = sliced.attach_carry(local, carry)
    result = joined.withColumns(
        {
            **{
                name: F.when(F.col(f"_before_{source}").isNull(), F.col(f"_run_{name}")).otherwise(
                    F.coalesce(F.col(f"_run_{name}"), F.lit(0)) + F.col(f"_before_{source}")
                )
                for name, source in sums.items()
            },
            **{
                name: F.when(F.col(HOT), F.col(f"_whole_{source}")).otherwise(F.col(f"_sum_{name}"))
                for name, source in totals.items()
            },
        }
    )
    return result.drop(
        SLICE,
        HOT,
        _ALL_ROWS,
        *[f"_before_{name}" for name in inputs],
        *[f"_whole_{name}" for name in inputs],
        *[f"_run_{name}" for name in sums],
        *[f"_sum_{name}" for name in totals],
    )


def next_match(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    left_id: str,
    right_time: str,
    match_time: str = "match_time",
    key_has_match: str | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Forward, strict as-of: for every left row the earliest right time later than its own, same key.

    Both sides are tagged and unioned; scanning each slice from the latest row backwards, the running minimum of
    the right times is the next match.  That frame grows by one row per step (linear), unlike a frame with an
    unbounded end, which Spark re-evaluates per row.  On equal times the right row comes first in order, so it
    is never matched.  Left rows without a follower, time or key get NULL.

    ``key_has_match`` adds a flag: the key has at least one right row with a time.
    """
    side, moment, tie, candidate = "_side", "_moment", "_tie", "_candidate"
    marked = left.select(
        "*",
        F.lit(1).alias(side),
        F.col(left_time).alias(moment),
        F.col(left_id).cast("string").alias(tie),
        F.lit(None).cast("timestamp").alias(candidate),
    )
    followers = (
        right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull())
        # Only distinct times matter to the nearest later one.
        .groupBy(F.col(key), F.col(right_time).cast("timestamp").alias(moment))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, moment, F.lit(0).alias(side), F.lit("").alias(tie), F.col(moment).alias(candidate))
    )
    both = marked.unionByName(followers, allowMissingColumns=True)
    sliced = slice_rows(both, [key], [moment, side, tie], policy)
    later_rows = sliced.window(descending=True).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = sliced.rows.select(
        "*",
        F.min(candidate).over(later_rows).alias("_local"),
        F.min(candidate).over(sliced.whole()).alias("_local_any"),
    ).where(F.col(side) == 1)
    usable = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    if sliced.is_split:
        later_slices = sliced.across_slices().rowsBetween(1, Window.unboundedFollowing)
        carry = sliced.carry({"_first": F.min(candidate)}).select(
            *sliced.slice_keys,
            F.min("_first").over(later_slices).alias("_later"),
            F.min("_first").over(Window.partitionBy(key)).alias("_any"),
        )
        scanned = sliced.attach_carry(scanned, carry).withColumns(
            {"_local": F.coalesce("_local", "_later"), "_local_any": F.coalesce("_local_any", "_any")}
        )
    result = scanned.withColumn(match_time, F.when(usable, F.col("_local")))
    if key_has_match:
        found = F.col(key).isNotNull() & F.col("_local_any").isNotNull()
        result = result.withColumn(key_has_match, found)
    return result.drop(SLICE, HOT, side, moment, tie, candidate, "_local", "_local_any", "_later", "_any")
