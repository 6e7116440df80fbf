"""Anomaly ensemble: isolation forest and one-class boundary with consensus, plus the reports on its flags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expressions import none_null, percent, present, safe_ratio
from ..operators.frequency import value_counts
from ..operators.quantiles import exact_quantiles
from ..operators.slicing import DEFAULT_POLICY, SlicePolicy
from ..session import materialize, spread
from .boundary import BoundaryModel, fit_boundary
from .isolation import IsolationForestModel, fit_forest
from .matrix import Standardizer

# Inputs of the ensemble and measures of its report.
ANOMALY_FEATURES = (
    "cout_total", "duree_intervention_par_heure", "time_to_closure_hours", "time_to_start_hours",
    "num_spare_parts_requests", "total_parts_cost", "equipment_failure_count", "equipment_avg_cost",
    "days_since_last_maintenance", "equipment_age_days", "site_failure_count", "zone_failure_count",
    "rolling_7d_failures", "rolling_30d_failures", "rolling_7d_avg_cost", "rolling_30d_avg_cost",
)
COMPARED = ("cout_total", "duree_intervention_par_heure", "time_to_closure_hours")
COMPARED_WIDE = (*COMPARED, "num_spare_parts_requests", "total_parts_cost")


@dataclass(frozen=True)
class AnomalyDetector:
    """Settings; :meth:`fit` returns the model."""

    contamination: float = 0.1
    trees: int = 100
    sample_size: int = 256
    map_size: int = 256
    steps: int = 28
    seed: int = 42
    policy: SlicePolicy = DEFAULT_POLICY

    def fit(self, df: DataFrame, identity: str = "id_ordre_travail") -> AnomalyModel:
        features = present(df, ANOMALY_FEATURES)
        # The narrow input is read once per step, so it is written once.
        rows = spread(materialize(df.select(identity, *features)))
        scaler = Standardizer.fit(rows, features, self.policy)
        scaled = rows.select(identity, *scaler.columns())
        names = [c for c in scaled.columns if c != identity]
        forest = fit_forest(scaled, identity, names, self.trees, self.sample_size, self.seed)
        scores = scaled.select(forest.score_column(df.sparkSession, names).alias("_score"))
        cut = exact_quantiles(scores, [], "_score", {"cut": self.contamination}, policy=self.policy).first()
        forest = replace(forest, threshold=float(cut["cut"]) if cut else None)
        boundary = fit_boundary(scaled, names, self.contamination, self.map_size, self.steps, self.seed)
        return AnomalyModel(scaler, forest, boundary, self.contamination)


@dataclass(frozen=True)
class AnomalyModel:
    scaler: Standardizer
    forest: IsolationForestModel
    boundary: BoundaryModel
    contamination: float = 0.1

    def transform(self, df: DataFrame) -> DataFrame:
        """Add both flags and scores, the consensus flag and the 0-2 confidence.

        Gaps are filled with the medians stored at fit time; works on batch and streaming frames.
        """
        inputs = self.scaler.columns()
        iso = self.forest.score_column(df.sparkSession, inputs)
        svm = self.boundary.score_column(inputs) - F.lit(self.boundary.rho)
        scored = df.withColumns({"iso_score": iso, "ocsvm_score": svm}).withColumns(
            {
                "iso_anomaly": (F.col("iso_score") < F.lit(self.forest.threshold)).cast("long"),
                "ocsvm_anomaly": (F.col("ocsvm_score") < 0).cast("long"),
            }
        )
        return anomaly_consensus(scored)

    def save(self, folder: str, spark: SparkSession) -> None:
        def write(table: DataFrame, name: str) -> None:
            table.write.mode("overwrite").parquet(f"{folder}/{name}")

        write(self.scaler.to_table(spark), "anomaly_scaler")
        write(spark.createDataFrame(self.forest.nodes), "anomaly_forest")
        b = self.boundary
        rows = [(i, b.directions[:, i].tolist(), float(b.phases[i]), float(b.weights[i])) for i in range(len(b.phases))]
        write(spark.createDataFrame(rows, "position int, direction array<double>, phase double, weight double"), "anomaly_boundary")
        settings = [(self.forest.sample_size, self.forest.threshold, b.rho, self.contamination)]
        write(
            spark.createDataFrame(settings, "sample_size int, threshold double, rho double, contamination double"),
            "anomaly_settings",
        )

    @classmethod
    def load(cls, folder: str, spark: SparkSession) -> AnomalyModel:
        read = lambda name: spark.read.parquet(f"{folder}/{name}")
        settings = read("anomaly_settings").first()
        rows = sorted(read("anomaly_boundary").collect(), key=lambda row: row["position"])
        boundary = BoundaryModel(
            np.array([row["direction"] for row in rows]).T,
            np.array([row["phase"] for row in rows]),
            np.array([row["weight"] for row in rows]),
            settings["rho"],
        )
        forest = IsolationForestModel(read("anomaly_forest").toPandas(), settings["sample_size"], settings["threshold"])
        return cls(Standardizer.from_table(read("anomaly_scaler")), forest, boundary, settings["contamination"])


# --- reports on flags -------------------------------------------------------------------------------------------

def anomaly_consensus(flagged: DataFrame, first: str = "iso_anomaly", second: str = "ocsvm_anomaly") -> DataFrame:
    """Either method flags -> consensus; how many flag -> confidence."""
    return flagged.withColumns(
        {
            "anomaly_consensus": F.greatest(first, second),
            "anomaly_confidence": F.col(first) + F.col(second),
        }
    )


def evaluate_anomalies(flagged: DataFrame) -> DataFrame:
    """One row: counts per method, union, intersection and agreement in percent."""
    rows = F.count(F.lit(1))
    return flagged.agg(
        rows.alias("total_samples"),
        F.sum("iso_anomaly").alias("isolation_forest_anomalies"),
        F.sum("ocsvm_anomaly").alias("ocsvm_anomalies"),
        F.sum("anomaly_consensus").alias("consensus_anomalies"),
        F.count_if(F.col("anomaly_confidence") == 2).alias("high_confidence_anomalies"),
        F.round(percent(F.count_if(F.col("iso_anomaly") == F.col("ocsvm_anomaly")), rows), 2).alias("agreement_pct"),
    )


def compare_groups(
    flagged: DataFrame, measures: Sequence[str] = COMPARED, flag: str = "anomaly_consensus"
) -> DataFrame:
    """Per measure: mean of normal and of flagged orders and their difference in percent (0 on a zero mean)."""
    hit = F.col(flag) == 1
    names = present(flagged, measures)
    means = flagged.agg(
        *[F.avg(F.when(~hit, F.col(n))).alias(f"normal_{i}") for i, n in enumerate(names)],
        *[F.avg(F.when(hit, F.col(n))).alias(f"flagged_{i}") for i, n in enumerate(names)],
    )

    def entry(i: int, name: str) -> Column:
        normal, other = F.col(f"normal_{i}"), F.col(f"flagged_{i}")
        change = F.when(normal != 0, safe_ratio(other - normal, normal) * 100).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(name).alias("feature"),
            F.round(normal, 2).alias("normal_mean"),
            F.round(other, 2).alias("anomaly_mean"),
            F.round(change, 1).alias("difference_pct"),
        )

    return means.select(F.inline(F.array(*[entry(i, n) for i, n in enumerate(names)])))


def anomaly_profile(
    flagged: DataFrame, names: Sequence[str] = ("site", "portfolio", "urgence", "etat"), flag: str = "iso_anomaly"
) -> DataFrame:
    """Share (percent) of each category among the flagged orders, per descriptive column."""
    hits = flagged.where(F.col(flag) == 1)
    pairs = F.inline(
        F.array(
            *[F.struct(F.lit(n).alias("factor"), F.col(n).cast("string").alias("value")) for n in present(flagged, names)]
        )
    )
    counts = value_counts(hits.select(pairs), "factor", "value")
    totals = counts.groupBy("factor").agg(F.sum("count").alias("_all"))
    return counts.join(totals, "factor").withColumn("share_pct", percent("count", "_all")).drop("_all")


def anomaly_rate_by(flagged: DataFrame, key: str = "site", flag: str = "iso_anomaly") -> DataFrame:
    """Flagged orders, orders and rate in percent per key, highest rate first."""
    return (
        flagged.where(none_null([key]))
        .groupBy(key)
        .agg(F.sum(flag).alias("anomalies"), F.count(flag).alias("orders"))
        .withColumn("rate_pct", percent("anomalies", "orders"))
        .orderBy(F.col("rate_pct").desc(), key)
    )


def method_overlap(flagged: DataFrame) -> DataFrame:
    """(category, count): both methods, only one of them, neither."""
    iso, svm = F.col("iso_anomaly") == 1, F.col("ocsvm_anomaly") == 1
    category = (
        F.when(iso & svm, "both").when(iso, "only_isolation_forest").when(svm, "only_one_class").otherwise("neither")
    )
    return flagged.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("count"))


def flag_correlations(flagged: DataFrame, features: Sequence[str], flag: str = "iso_anomaly") -> DataFrame:
    """Absolute correlation of each feature with the flag, strongest first; all in one aggregate."""
    names = present(flagged, features)
    row = flagged.agg(*[F.abs(F.corr(F.col(n).cast("double"), F.col(flag).cast("double"))).alias(f"c{i}") for i, n in enumerate(names)])
    entries = [F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("correlation")) for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*entries))).orderBy(F.col("correlation").desc_nulls_last(), "feature")
