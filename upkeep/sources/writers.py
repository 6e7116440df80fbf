"""Table and report sinks.  Nothing is pulled to the driver; every sink writes in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T


def write_table(df: DataFrame, folder: str, name: str, csv: bool = False, partition_by: str | None = None) -> str:
    """Typed Parquet table, optionally with a CSV twin (header, UTF-8) for spreadsheet users and its schema beside it.

    With ``partition_by`` the rows are rebalanced first: small folders are merged into one task and large ones split, so
    the number of files follows the data and not the tasks.
    """
    path = f"{folder}/{name}.parquet"
    if partition_by:
        df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    if csv:
        stored = df.sparkSession.read.parquet(path)
        stored.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
        written = df.sparkSession.createDataFrame([(stored.schema.json(),)], "value string")
        written.coalesce(1).write.mode("overwrite").text(f"{folder}/{name}.schema")
    return path


def write_tables(tables: Mapping[str, DataFrame], folder: str, csv: bool = False) -> list[str]:
    return [write_table(df, folder, name, csv) for name, df in tables.items()]


def write_timeline(timeline: DataFrame, folder: str, name: str = "unified_timeline") -> str:
    """Partitioned by month, so date filters prune whole folders."""
    return write_table(
        timeline.withColumn("month", F.date_format("date_created", "yyyy-MM")), folder, name, partition_by="month"
    )


def write_summary(summary: DataFrame, folder: str, name: str) -> str:
    """A one-row report as JSON."""
    path = f"{folder}/{name}.json"
    summary.write.mode("overwrite").json(path)
    return path


def feature_metadata(features: DataFrame, targets: list[str]) -> DataFrame:
    """One row: sample and column counts, numeric / text / target column names, creation time."""
    numeric = [f.name for f in features.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in features.schema.fields if isinstance(f.dataType, T.StringType)]

    def names(values: list[str]):
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return features.agg(F.count(F.lit(1)).alias("total_samples")).select(
        "total_samples",
        F.lit(len(features.columns)).cast("long").alias("total_features"),
        names(numeric).alias("numerical_features"),
        names(text).alias("categorical_features"),
        names([t for t in targets if t in features.columns]).alias("target_variables"),
        F.current_timestamp().alias("created_date"),
    )
