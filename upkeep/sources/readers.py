"""Table sources: raw exports, processed tables, JSON summaries, models' companions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from ..functions.expressions import parse_mixed_time, present
from .schemas import RAW_TABLES

_FORMATS = ("parquet", "csv")


def _path(spark: SparkSession, location: str):
    return spark._jvm.org.apache.hadoop.fs.Path(location)


def path_exists(spark: SparkSession, location: str) -> bool:
    """Works on any Hadoop file system, not only the driver's disk."""
    path = _path(spark, location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    path = _path(spark, folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []


def locate(spark: SparkSession, folder: str, name: str) -> tuple[str, str]:
    """(format, path) of a table, the typed format first; the error lists what the folder holds."""
    for kind in _FORMATS:
        for candidate in (f"{folder}/{name}.{kind}", f"{folder}/{name}"):
            if path_exists(spark, candidate) and (
                candidate.endswith(f".{kind}") or kind == table_format(spark, candidate)
            ):
                return kind, candidate
    raise FileNotFoundError(f"no table {name!r} in {folder}; found: {list_names(spark, folder)}")


def table_format(spark: SparkSession, folder: str) -> str | None:
    for kind in _FORMATS:
        if any(kind in name.rsplit(".", 2) or name.endswith(f".{kind}") for name in list_names(spark, folder)):
            return kind
    return None


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL everywhere downstream; NaN would poison averages."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: F.nanvl(F.col(name), F.lit(None)) for name in doubles}) if doubles else df


def csv_reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    """Header, doubled quotes, UTF-8.  Line breaks inside quotes need ``multiline``, which reads each file in one task.

    The header of every file must name the columns in the order of the schema; a file that differs is an error.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("enforceSchema", False)
    return reader.option("multiLine", multiline)


def read_raw_tables(spark: SparkSession, folder: str, multiline: bool = False) -> dict[str, DataFrame]:
    """The three exports as declared in :mod:`schemas`, from Parquet or CSV; lazy.

    Large CSV files are split; ``multiline=True`` is for exports with line breaks in their texts.
    """
    tables = {}
    for name, schema in RAW_TABLES.items():
        kind, path = locate(spark, folder, name)
        table = spark.read.parquet(path) if kind == "parquet" else _read_exported_csv(spark, path, schema, multiline)
        tables[name] = nan_to_null(table)
    return tables


def _read_exported_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> DataFrame:
    """Exports may order or omit columns, so types are applied by header name."""
    header = csv_reader(spark, multiline).csv(path).columns
    known = {field.name: field for field in schema.fields}
    clean = [name.lstrip("\ufeff") for name in header]
    ordered = T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in clean])
    return csv_reader(spark, multiline).schema(ordered).csv(path)


def written_schema(spark: SparkSession, folder: str, name: str) -> T.StructType | None:
    """The schema that the table sink wrote beside a CSV table."""
    path = f"{folder}/{name}.schema"
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()["value"])) if path_exists(spark, path) else None


def read_table(
    spark: SparkSession,
    folder: str,
    name: str,
    time_columns: Sequence[str] = (),
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """A processed table: Parquet when present, else CSV whose listed time columns are parsed again.

    The CSV is read once if its ``schema`` is given or was written beside it by the table sink; only the CSV of another
    program without one has its types inferred by a scan before.
    """
    kind, path = locate(spark, folder, name)
    if kind == "parquet":
        return spark.read.parquet(path)
    schema = schema or written_schema(spark, folder, name)
    reader = csv_reader(spark, multiline)
    table = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    times = [n for n in present(table, time_columns) if not isinstance(table.schema[n].dataType, T.TimestampType)]
    return table.withColumns({n: parse_mixed_time(F.col(n).cast("string")) for n in times}) if times else table


def read_summary(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A JSON summary written by the report sink, or None when the step has not run."""
    path = f"{folder}/{name}.json"
    return spark.read.json(path) if path_exists(spark, path) else None

