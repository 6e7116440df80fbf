"""Stateless scoring of arriving orders: the batch operator applied to a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..models.anomaly import AnomalyModel
from ..models.classifiers import Classifier
from ..models.scoring import ScoringProfile, score_orders


def arriving_orders(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New order files dropped into a folder, read once each."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def score_stream(
    orders: DataFrame,
    profile: ScoringProfile,
    output: str,
    checkpoint: str,
    failure: Classifier | None = None,
    parts: Classifier | None = None,
    anomaly: AnomalyModel | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append scored orders as Parquet; exactly once through the sink's log and the checkpoint."""
    writer = (
        score_orders(orders, profile, failure, parts, anomaly)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
