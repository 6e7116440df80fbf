"""Per-key statistics attached back to their rows, with the join strategy chosen from a measured size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import none_null, text_or_nan
from ..session import store
from .ordered import running_totals
from .slicing import DEFAULT_POLICY, SlicePolicy

# Largest lookup, in bytes of its rows in memory, that is sent to every executor; larger ones take the shuffled join.
BROADCAST_BYTES = 32 << 20
# In-memory size of a value of fixed width with its share of the row, and of a text beyond its letters.
_VALUE_BYTES, _TEXT_BYTES = 8, 16


@dataclass(frozen=True)
class Lookup:
    """A table with one row per key, and its size in bytes as measured when it was stored."""

    table: DataFrame
    keys: tuple[str, ...]
    size: int

    def attach(self, rows: DataFrame) -> DataFrame:
        """Left join: broadcast when the measured size allows, else sort-merge.

        Beyond the limit the keys are numerous; AQE splits whatever partition of the row side stays skewed.
        """
        table = F.broadcast(self.table) if self.size <= BROADCAST_BYTES else self.table.hint("merge")
        return rows.join(table, list(self.keys), "left")

    def keep(self, *names: str, **renamed: str) -> Lookup:
        """Choose columns: ``names`` as they are, ``renamed`` as output=input."""
        chosen = [*names, *[F.col(source).alias(out) for out, source in renamed.items()]]
        return Lookup(self.table.select(*self.keys, *chosen), self.keys, self.size)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: fixed-width values, and texts by their length."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    fixed = _VALUE_BYTES * (len(df.columns) + 1) + _TEXT_BYTES * len(texts)
    return sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in texts), F.lit(fixed)).cast("long")


def key_statistics(
    df: DataFrame, key_sets: Sequence[Sequence[str]], aggregates: Mapping[str, Column]
) -> dict[tuple[str, ...], Lookup]:
    """The same aggregates for several keys in one scan (grouping sets), materialised and counted.

    Rows with a missing key form no group.
    """
    names = list(dict.fromkeys(name for keys in key_sets for name in keys))
    grouped = (
        df.groupingSets([[F.col(name) for name in keys] for keys in key_sets], *[F.col(name) for name in names])
        .agg(F.grouping_id().alias("_set"), *[agg.alias(name) for name, agg in aggregates.items()])
    )
    marks = {tuple(keys): sum(1 << (len(names) - 1 - i) for i, name in enumerate(names) if name not in keys) for keys in key_sets}
    weight = row_bytes(grouped)
    measures = {f"set_{mark}": F.sum(F.when(F.col("_set") == mark, weight)) for mark in marks.values()}
    stored, sizes = store(grouped, **measures)
    lookups = {}
    for keys in key_sets:
        mark = marks[tuple(keys)]
        table = stored.where((F.col("_set") == mark) & none_null(list(keys))).select(*keys, *aggregates)
        lookups[tuple(keys)] = Lookup(table, tuple(keys), sizes[f"set_{mark}"] or 0)
    return lookups


def category_codes(
    df: DataFrame, names: Sequence[str], policy: SlicePolicy = DEFAULT_POLICY
) -> dict[str, Lookup]:
    """Code of every text value: its rank among the distinct values in code-point order, missing = ``nan``.

    One pass collects the distinct values of all columns (map-side combined); the rank is a sliced running
    count, so a column with very many values is still ranked in parallel.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), text_or_nan(n).alias("value")) for n in names]))
    distinct, found = store(
        df.select(pairs.alias("_pair"))
        .groupBy(F.col("_pair.name").alias("name"), F.col("_pair.value").alias("value"))
        .agg(F.lit(1).cast("long").alias("_one")),
        rows=F.count(F.lit(1)),
    )
    ranked = running_totals(distinct, ["name"], ["value"], {"_rank": "_one"}, policy=policy, size=found["rows"])
    ranked = ranked.select("name", "value", (F.col("_rank") - 1).alias("code"))
    weight = row_bytes(ranked)
    stored, sizes = store(ranked, **{f"of_{i}": F.sum(F.when(F.col("name") == name, weight)) for i, name in enumerate(names)})
    return {
        name: Lookup(
            stored.where(F.col("name") == name).select(F.col("value").alias(name), F.col("code").alias("code")),
            (name,),
            sizes[f"of_{i}"] or 0,
        )
        for i, name in enumerate(names)
    }


def attach_codes(rows: DataFrame, codes: Mapping[str, Lookup], outputs: Mapping[str, str]) -> DataFrame:
    """Add the code columns: ``outputs`` maps a text column to its code column."""
    for name, output in outputs.items():
        helper = f"_key_{name}"
        lookup = codes[name]
        table = Lookup(
            lookup.table.select(F.col(name).alias(helper), F.col("code").alias(output)), (helper,), lookup.size
        )
        rows = table.attach(rows.withColumn(helper, text_or_nan(name))).drop(helper)
    return rows


def with_summary(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Add the columns of a one-row ``summary`` to every row, as one scalar subquery (no join)."""
    packed = "_summary"
    return rows.withColumn(packed, summary.select(F.struct(*summary.columns)).scalar()).select(
        *rows.columns, *[F.col(f"{packed}.{name}") for name in summary.columns]
    )
