"""Counting operators: value counts, modes, first distinct values, duplicates, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expressions import none_null, text_or_nan
from .lookups import with_summary


def value_counts(df: DataFrame, *names: str, count: str = "count") -> DataFrame:
    """Rows per distinct (non-null) combination."""
    return df.where(none_null(names)).groupBy(*names).agg(F.count(F.lit(1)).alias(count))


def top_counts(df: DataFrame, name: str, limit: int | None, count: str = "count") -> DataFrame:
    """Most frequent values first; ties by value."""
    ordered = value_counts(df, name, count=count).orderBy(F.col(count).desc(), F.col(name))
    return ordered.limit(limit) if limit else ordered


def modes(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Most frequent value of each text column per key, smallest on ties, NULL when all are missing.

    The rows are unpivoted and counted per (key, column, value) with map-side combine, so no task ever holds
    the value map of a whole key.
    """
    keys = list(keys)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value")) for name in names])
    )
    counted = (
        df.where(none_null(keys))
        .select(*keys, pairs.alias("_pair"))
        .groupBy(*keys, F.col("_pair.name").alias("_name"), F.col("_pair.value").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    picks = [
        F.min_by(
            "_value",
            F.when(
                (F.col("_name") == name) & F.col("_value").isNotNull(), F.struct(-F.col("_n"), F.col("_value"))
            ),
        ).alias(name)
        for name in names
    ]
    return counted.groupBy(*keys).agg(*picks)


def first_distinct(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    output: str,
    limit: int | None = None,
    separator: str = ", ",
) -> DataFrame:
    """Distinct values per key in order of first appearance, joined to one text.

    A missing value reads ``nan``.  With ``limit`` the rank filter is applied before the shuffle (window group
    limit), so a hot key ships only ``limit`` rows per map task.
    """
    keys = list(keys)
    firsts = (
        df.where(none_null(keys))
        .groupBy(*keys, text_or_nan(value).alias("_value"))
        .agg(F.min(F.struct(*order)).alias("_first"))
    )
    if limit:
        place = Window.partitionBy(*keys).orderBy("_first", "_value")
        firsts = firsts.withColumn("_rank", F.row_number().over(place)).where(F.col("_rank") <= limit)
    ordered = F.sort_array(F.collect_list(F.struct("_first", "_value")))
    return firsts.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda item: item["_value"]), separator).alias(output)
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier identical row."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))
    )


def histogram(df: DataFrame, value: str | Column, bins: int) -> DataFrame:
    """Equal-width bins over the whole value range; the last bin is closed."""
    data = df.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("_v"))
    data = data.where(F.col("_v").isNotNull())
    low, high = F.min("_v"), F.max("_v")
    placed = with_summary(data, data.agg(low.alias("_low"), ((high - low) / F.lit(bins)).alias("_width")))
    bucket = F.when(F.col("_width") > 0, F.least(F.floor((F.col("_v") - F.col("_low")) / F.col("_width")), F.lit(bins - 1)))
    return (
        placed.withColumn("bin", F.coalesce(bucket, F.lit(0)).cast("long"))
        .groupBy("bin", "_low", "_width")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
            "count",
        )
    )


def unpivot_row(df: DataFrame, rows: Mapping[str, Mapping[str, str | Column]], label: str = "metric") -> DataFrame:
    """Turn a one-row summary into labelled rows: ``rows`` maps a label to output -> input column."""
    entries = [
        F.struct(
            F.lit(name).alias(label),
            *[(F.col(c) if isinstance(c, str) else c).cast("double").alias(out) for out, c in fields.items()],
        )
        for name, fields in rows.items()
    ]
    return df.select(F.inline(F.array(*entries)))
