"""Session settings and the checkpoint folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

# The JVM compiles no method of more than 8,000 bytes, and interprets it row by row.  Expressions over many columns
# (seventy features, forty rounded doubles) exceed that in one generated method; beyond this limit Spark splits them.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def build_session(app_name: str = "upkeep", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator assumes: UTC clock, AQE with skew handling."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        METHOD_LIMIT[0]: METHOD_LIMIT[1],
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that ``spark.checkpoint.dir`` names.

    Executors of a cluster do not share their local folders, so there the setting is required.  A session in one
    process (``local[...]``) without it gets a temporary folder, which all its tasks see.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="upkeep-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once, so that later jobs survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, **measures: Column) -> tuple[DataFrame, Mapping[str, Any]]:
    """``df`` written once as a table to the checkpoint folder, and ``measures`` (aggregates of its rows) of what was written.

    Unlike a checkpoint it is written by one job and has columns to choose from.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    taken = stored.agg(*[measure.alias(name) for name, measure in measures.items()]).first().asDict() if measures else {}
    return stored, taken


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for work that computes much on few bytes.

    Adaptive execution packs a small stored table into very few partitions, which is right for reading it and
    wrong for iterating over it.  Large tables have more partitions than cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else materialize(df.repartition(cores))
