"""Exact, interpolated quantiles whose groups may hold any share of the rows.

``percentile`` keeps every distinct value of a group in one task, which is right for small groups only.  One way serves
every size:

1. a quantile sketch (map-side merged) brackets the wanted ranks with a safe margin;
2. values below the bracket are only counted, values inside it are counted one by one (map-side combined) and stored;
3. the wanted ranks are picked from those few values by a running count, in slices where they are many.

The rows are read twice and never shuffled by value.  Whether every bracket holds its rank is measured on the stored values;
a bracket that misses it is widened, in the end to all values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import column, none_null
from ..session import store
from .lookups import Lookup, row_bytes, with_summary
from .ordered import running_totals
from .slicing import DEFAULT_POLICY, SlicePolicy

# Rank accuracy of the sketch (error at most 1/accuracy), and the first half-width of a bracket in such errors.
MARGIN = 5.0
ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    quantiles: Mapping[str, float],
    mean: str | None = None,
    count: str | None = None,
    total: str | None = None,
    policy: SlicePolicy = DEFAULT_POLICY,
    accuracy: int = ACCURACY,
    margin: float = MARGIN,
) -> DataFrame:
    """Quantiles of the non-null values per key (one row overall when ``keys`` is empty).

    ``mean``, ``count`` and ``total`` name extra outputs.  Groups whose values are all NULL do not appear; rows
    with a missing key are dropped, as in every grouped report.
    """
    keys = list(keys)
    data = df.select(*keys, column(value).cast("double").alias("_value"))
    data = data.where(none_null(keys) & F.col("_value").isNotNull())
    extras = {
        name: build
        for name, build in (
            (count, F.count("_value")),
            (total, F.sum("_value")),
            (mean, F.avg("_value")),
        )
        if name
    }
    while True:
        counted, rows, missed = _counted_values(data, keys, quantiles, extras, accuracy, margin / accuracy)
        if not missed:
            break
        margin = max(10 * margin, 1.0 / accuracy)
    # The one row outside is everything below the bracket, and sorts first.
    ranked = running_totals(counted, [*keys, "_q"], ["_inside", "_value"], {"_upto": "_weight"}, policy=policy, size=rows)

    def at(i: int, place: Column) -> Column:
        return F.min(F.when((F.col("_q") == i) & (F.col("_upto") > place), F.col("_value")))

    # Over no rows there is no ``_n``, hence no row.  A single quantile stays where its running count was made.
    single = ["_q"] if len(quantiles) == 1 else []
    picked = ranked.groupBy(*keys, *single, "_n").agg(
        *[F.max(f"_extra_{name}").alias(name) for name in extras],
        *[at(i, F.floor(_rank(share))).alias(f"_low{i}") for i, share in enumerate(quantiles.values())],
        *[at(i, F.ceil(_rank(share))).alias(f"_high{i}") for i, share in enumerate(quantiles.values())],
    )

    def exact(i: int, share: float) -> Column:
        low, high, rank = F.col(f"_low{i}"), F.col(f"_high{i}"), _rank(share)
        return F.when(low == high, low).otherwise(low + (high - low) * (rank - F.floor(rank)))

    return picked.select(*keys, *extras, *[exact(i, share).alias(name) for i, (name, share) in enumerate(quantiles.items())])


def _rank(share: float) -> Column:
    return (F.col("_n") - 1) * F.lit(float(share))


def _counted_values(
    data: DataFrame,
    keys: list[str],
    quantiles: Mapping[str, float],
    extras: Mapping[str, Column],
    accuracy: int,
    margin: float,
) -> tuple[DataFrame, int, bool]:
    """Stored counts per key and quantile of what is below its bracket (one row) and of each value inside it.

    Also the number of these rows, and whether some rank lies outside its bracket.
    """
    # With fewer rows the margin would be below the two ranks an interpolation needs; such a group keeps all values.
    whole = F.col("_n") <= 10 * accuracy

    shares = list(quantiles.values())
    # All bounds come from one sketch.
    bounds = [min(1.0, max(0.0, share + side)) for share in shares for side in (-margin, margin)]
    brackets = data.groupBy(*keys).agg(
        F.count("_value").alias("_n"),
        F.min("_value").alias("_min"),
        F.max("_value").alias("_max"),
        F.percentile_approx("_value", bounds, accuracy).alias("_bounds"),
        *[agg.alias(f"_extra_{name}") for name, agg in extras.items()],
    )
    extra = [f"_extra_{name}" for name in extras]
    edges = brackets.select(
        *keys,
        "_n",
        *extra,
        *[
            F.struct(
                F.lit(i).alias("q"),
                F.when(whole | F.lit(share <= margin), F.col("_min")).otherwise(F.col("_bounds")[2 * i]).alias("lo"),
                F.when(whole | F.lit(share >= 1 - margin), F.col("_max")).otherwise(F.col("_bounds")[2 * i + 1]).alias("hi"),
            ).alias(f"_edge{i}")
            for i, share in enumerate(shares)
        ],
    )
    if keys:
        table, measured = store(edges, size=F.sum(row_bytes(edges) + 32 * len(shares)), keys=F.count(F.lit(1)))
        placed = Lookup(table, tuple(keys), measured["size"] or 0).attach(data)
    else:
        placed = with_summary(data, edges)
    # A row matters to a quantile when it is below its bracket (counted) or inside it (kept by value).
    # Exploded before the comparison, so that it is compiled; a lambda over the brackets would be interpreted.
    edge = F.col("_edge0") if len(shares) == 1 else F.explode(F.array(*[F.col(f"_edge{i}") for i in range(len(shares))]))
    inside = F.col("_edge.lo") <= F.col("_value")
    counted = (
        placed.select(*keys, "_n", *extra, "_value", edge.alias("_edge"))
        .where(F.col("_value") <= F.col("_edge.hi"))
        .groupBy(*keys, "_n", F.col("_edge.q").alias("_q"), inside.alias("_inside"), F.when(inside, F.col("_value")).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_weight"), *[F.max(name).alias(name) for name in extra])
    )
    below, upto = F.sum(F.when(~F.col("_inside"), F.col("_weight")).otherwise(0)), F.sum("_weight")
    if not keys:  # a group is a quantile here, so one row of sums tells
        only = lambda i, fold: F.sum(F.when(F.col("_q") == i, fold).otherwise(0))
        weight = F.col("_weight")
        measures = {f"below{i}": only(i, F.when(~F.col("_inside"), weight).otherwise(0)) for i in range(len(shares))}
        measures |= {f"upto{i}": only(i, weight) for i in range(len(shares))}
        stored, seen = store(counted, rows=F.count(F.lit(1)), n=F.max("_n"), **measures)
        n = seen["n"]
        missed = n is not None and any(
            math.floor((n - 1) * share) < seen[f"below{i}"] or math.ceil((n - 1) * share) >= seen[f"upto{i}"]
            for i, share in enumerate(shares)
        )
        return stored, seen["rows"], missed
    stored, seen = store(counted, rows=F.count(F.lit(1)))
    rank = (F.col("_n") - 1) * F.element_at(F.array(*[F.lit(float(share)) for share in shares]), F.col("_q") + 1)
    groups = stored.groupBy(*keys, "_n", "_q").agg(below.alias("_below"), upto.alias("_upto"))
    outside = (F.floor(rank) < F.col("_below")) | (F.ceil(rank) >= F.col("_upto"))
    # A quantile without any counted row has no group to be found in, so the groups are counted, too.
    found = groups.agg(F.count_if(outside).alias("outside"), F.count(F.lit(1)).alias("groups")).first()
    return stored, seen["rows"], bool(found["outside"]) or found["groups"] < len(shares) * measured["keys"]


def describe(
    df: DataFrame, keys: Sequence[str], value: str | Column, policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max per key."""
    keys = list(keys)
    data = df.select(*keys, column(value).cast("double").alias("_v")).where(none_null(keys))
    moments = data.groupBy(*keys).agg(
        F.count("_v").alias("count"),
        F.avg("_v").alias("mean"),
        F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    quartiles = exact_quantiles(data, keys, "_v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, policy=policy)
    if keys:
        joined = moments.join(quartiles, keys, "left")
    else:
        joined = with_summary(moments, quartiles)
    return joined.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")
