"""Training step: feature table -> fitted models, flags and metrics on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.writers import write_summary, write_table
from .anomaly import AnomalyDetector, compare_groups, evaluate_anomalies
from .classifiers import FAILURE_SETTINGS, PARTS_SETTINGS, ModelSettings, Training, train_failure_model, train_parts_model


def packed(table: DataFrame) -> DataFrame:
    """All rows of a small report table as one array column of one row."""
    return table.agg(F.collect_list(F.struct(*table.columns)).alias("rows"))


def training_summary(training: Training) -> DataFrame:
    """One row: metrics plus report, confusion cells and top inputs as arrays."""
    summary = training.metrics
    for name, table in (
        ("classification_report", training.report),
        ("confusion_matrix", training.confusion),
        ("feature_importance", training.classifier.importances()),
    ):
        summary = summary.withColumn(name, packed(table).scalar())
    return summary


def run_models(
    spark: SparkSession,
    features_folder: str,
    models_folder: str,
    failure_settings: ModelSettings = FAILURE_SETTINGS,
    parts_settings: ModelSettings = PARTS_SETTINGS,
    detector: AnomalyDetector = AnomalyDetector(),
) -> DataFrame:
    """Fit the ensemble and both classifiers, write models, flagged orders and the metrics JSON."""
    features = spark.read.parquet(f"{features_folder}/corrective_features.parquet")
    ensemble = detector.fit(features)
    ensemble.save(f"{models_folder}/anomaly", spark)
    flagged = spark.read.parquet(write_table(ensemble.transform(features), models_folder, "anomaly_predictions"))
    failure = train_failure_model(features, failure_settings)
    failure.classifier.save(f"{models_folder}/failure_predictor")
    parts = train_parts_model(features, parts_settings)
    parts.classifier.save(f"{models_folder}/spare_parts_predictor")
    anomaly = evaluate_anomalies(flagged).withColumn("feature_comparison", packed(compare_groups(flagged)).scalar())
    blocks = {
        "anomaly_detection": anomaly,
        "failure_prediction": training_summary(failure),
        "spare_parts_prediction": training_summary(parts),
    }
    metrics = spark.range(1).select(
        *[block.select(F.struct(*block.columns)).scalar().alias(name) for name, block in blocks.items()]
    )
    write_summary(metrics, models_folder, "model_metrics")
    return spark.read.json(f"{models_folder}/model_metrics.json")
