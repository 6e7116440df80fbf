"""Exploration reports: volumes, reliability, recurrence, providers, cost and closure-time profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import guarded_ratio, none_null, percent, safe_ratio, weekday_label
from ..operators.correlation import correlations
from ..operators.frequency import histogram, top_counts, value_counts
from ..operators.lookups import category_codes, with_summary
from ..operators.quantiles import describe, exact_quantiles
from ..operators.slicing import DEFAULT_POLICY, SlicePolicy
from ..session import materialize
from .features import days_since_previous

ASSET, FAMILY, ORDER_ID = "id_actif", "famille", "id_ordre_travail"
ALL_SITES = "Tous"
MIN_MTBF_OBSERVATIONS = 5
RECURRING_ORDERS = 3


def at_site(df: DataFrame, site: str | None = None) -> DataFrame:
    """Optional site filter of every report; it reaches the scan as a pushed predicate."""
    return df if site in (None, ALL_SITES) else df.where(F.col("site") == site)


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0.0))


# --- volumes ------------------------------------------------------------------------------------------------------

def daily_volume(timeline: DataFrame) -> DataFrame:
    day = F.to_date("date_created").alias("date")
    return value_counts(timeline.select(day, "maintenance_type"), "date", "maintenance_type")


def daily_volume_profile(timeline: DataFrame) -> DataFrame:
    """Distribution of the daily counts per kind; days on which only the other kind occurred count as 0."""
    kinds = ("corrective", "preventive")
    per_day = (
        timeline.where(F.col("date_created").isNotNull())
        .groupBy(F.to_date("date_created").alias("date"))
        .agg(*[F.count_if(F.col("maintenance_type") == kind).alias(kind) for kind in kinds])
    )
    stacked = per_day.select(
        F.inline(
            F.array(*[F.struct(F.lit(k).alias("maintenance_type"), F.col(k).alias("daily_count")) for k in kinds])
        )
    )
    return describe(stacked, ["maintenance_type"], "daily_count")


def weekday_volume(timeline: DataFrame) -> DataFrame:
    weekday = F.weekday("date_created").cast("long").alias("day_of_week")
    counts = value_counts(timeline.select(weekday, "maintenance_type"), "day_of_week", "maintenance_type")
    return counts.withColumn("jour", weekday_label(F.col("day_of_week").cast("int")))


def hourly_volume(timeline: DataFrame) -> DataFrame:
    hour = F.hour("date_created").cast("long").alias("hour")
    return value_counts(timeline.select(hour, "maintenance_type"), "hour", "maintenance_type")


def busiest_times(timeline: DataFrame) -> DataFrame:
    """One row: weekday label and hour with most events (earliest on ties)."""
    known = timeline.where(F.col("date_created").isNotNull())

    def busiest(part: Column, name: str) -> DataFrame:
        counts = known.groupBy(part.cast("long").alias(name)).agg(F.count(F.lit(1)).alias("_n"))
        return counts.agg(F.min_by(name, F.struct(-F.col("_n"), F.col(name))).alias(name))

    both = with_summary(busiest(F.weekday("date_created"), "_day"), busiest(F.hour("date_created"), "busiest_hour"))
    return both.select(weekday_label(F.col("_day").cast("int")).alias("busiest_day"), "busiest_hour")


def overview(corrective: DataFrame, preventive: DataFrame, assets: DataFrame, timeline: DataFrame) -> DataFrame:
    """One row of table sizes."""
    counts = timeline.agg(F.count(F.lit(1)).alias("total_events"))
    for df, name in ((corrective, "corrective_orders"), (preventive, "preventive_orders"), (assets, "assets")):
        counts = with_summary(counts, df.agg(F.count(F.lit(1)).alias(name)))
    return counts


def headline_metrics(model_metrics: DataFrame) -> DataFrame:
    """F1 / AUC of both classifiers and the anomaly count and agreement, from the stored model summary."""
    wanted = {
        "failure_f1": "failure_prediction.test_f1",
        "failure_auc": "failure_prediction.test_roc_auc",
        "parts_f1": "spare_parts_prediction.test_f1",
        "parts_auc": "spare_parts_prediction.test_roc_auc",
        "anomalies": "anomaly_detection.consensus_anomalies",
        "agreement_pct": "anomaly_detection.agreement_pct",
    }
    return model_metrics.select(*[F.coalesce(F.col(path).cast("double"), F.lit(0.0)).alias(n) for n, path in wanted.items()])


def top_anomaly_types(corrective: DataFrame, limit: int | None = 15) -> DataFrame:
    return top_counts(corrective, "anomalie", limit)


def distribution(df: DataFrame, name: str) -> DataFrame:
    """Counts of a status-like column with its share in percent."""
    counts = value_counts(df, name)
    return (
        with_summary(counts, counts.agg(F.sum("count").alias("_all")))
        .withColumn("share_pct", percent("count", "_all"))
        .drop("_all")
        .orderBy(F.col("count").desc(), name)
    )


# --- reliability --------------------------------------------------------------------------------------------------

def mtbf_by_family(
    corrective: DataFrame,
    limit: int | None = 15,
    min_observations: int = MIN_MTBF_OBSERVATIONS,
    policy: SlicePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Mean and median days between failures of one asset, per family, least reliable first."""
    gaps = days_since_previous(corrective.select(ASSET, FAMILY, "date_creation_ot", ORDER_ID), policy)
    gaps = materialize(gaps.select(FAMILY, "days_since_previous"))  # read twice
    stats = exact_quantiles(
        gaps, [FAMILY], "days_since_previous", {"median_days": 0.5}, mean="mtbf_days", count="observations", policy=policy
    )
    ordered = stats.where(F.col("observations") >= min_observations).orderBy("mtbf_days", FAMILY)
    return ordered.limit(limit) if limit else ordered


def failure_hotspots(corrective: DataFrame, keys: Sequence[str] = ("site",)) -> DataFrame:
    """Failures, cost and high-urgency orders per site or (site, zone)."""
    return (
        corrective.where(none_null(keys))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("failure_count"),
            _total("cout_total").alias("total_cost"),
            F.count_if(F.col("urgence") == "Fort").alias("high_urgency_count"),
        )
        .orderBy(F.col("failure_count").desc(), *keys)
    )


def recurrence_summary(corrective: DataFrame) -> DataFrame:
    """One row: recurring assets, their mean failures, assets with three or more and their cost share, reopenings."""
    per_asset = corrective.where(none_null([ASSET])).groupBy(ASSET).agg(
        F.count(F.lit(1)).alias("_n"), _total("cout_total").alias("_cost")
    )
    many = F.col("_n") >= RECURRING_ORDERS
    assets = per_asset.agg(
        F.count_if(F.col("_n") > 1).alias("recurring_assets"),
        F.avg(F.when(F.col("_n") > 1, F.col("_n"))).alias("avg_failures_per_recurring"),
        F.count_if(many).alias("assets_3plus"),
        F.coalesce(F.sum(F.when(many, F.col("_cost"))), F.lit(0.0)).alias("cost_3plus"),
    )
    orders = corrective.agg(
        _total("cout_total").alias("_all_cost"),
        F.count_if(F.col("est_reouvert")).alias("reopened_orders"),
        percent(F.count_if(F.col("est_reouvert")), F.count(F.lit(1))).alias("reopen_rate_pct"),
    )
    return (
        with_summary(assets, orders).withColumn("cost_3plus_pct", percent("cost_3plus", "_all_cost")).drop("_all_cost")
    )


def top_recurring_assets(corrective: DataFrame, limit: int = 10) -> DataFrame:
    keys = (ASSET, FAMILY, "site")
    return (
        corrective.where(none_null(keys))
        .groupBy(*keys)
        .agg(F.count(ORDER_ID).alias("failures"), _total("cout_total").alias("total_cost"))
        .orderBy(F.col("failures").desc(), *keys)
        .limit(limit)
    )


# --- providers, times, costs ----------------------------------------------------------------------------------------

def provider_performance(corrective: DataFrame, limit: int | None = None) -> DataFrame:
    """Orders, mean closure time, cost and duration per provider, busiest first."""
    stats = (
        corrective.where(none_null(["prestataire"]))
        .groupBy("prestataire")
        .agg(
            F.count(ORDER_ID).alias("order_count"),
            F.avg("time_to_closure_hours").alias("avg_time_to_closure"),
            F.avg("cout_total").alias("avg_cost"),
            F.avg("duree_intervention_par_heure").alias("avg_duration"),
        )
        .orderBy(F.col("order_count").desc(), "prestataire")
    )
    return stats.limit(limit) if limit else stats


def provider_spread(corrective: DataFrame) -> DataFrame:
    """One row: fastest and slowest mean closure time and their ratio (0 when the fastest is not positive)."""
    means = corrective.where(none_null(["prestataire"])).groupBy("prestataire").agg(
        F.avg("time_to_closure_hours").alias("_mean")
    )
    return means.agg(F.min("_mean").alias("fastest_hours"), F.max("_mean").alias("slowest_hours")).withColumn(
        "provider_ratio", guarded_ratio("slowest_hours", "fastest_hours")
    )


def closure_time_summary(corrective: DataFrame) -> DataFrame:
    """One row: mean and median closure time, mean intervention time."""
    closure = exact_quantiles(
        corrective, [], "time_to_closure_hours", {"median_time_to_closure": 0.5}, mean="avg_time_to_closure"
    )
    return with_summary(closure, corrective.agg(F.avg("duree_intervention_par_heure").alias("avg_duration")))


def closure_time_histogram(corrective: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(corrective, "time_to_closure_hours", bins)


def closure_time_by(corrective: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Mean, median and count of the closure time per urgency, family, ...; slowest first."""
    stats = exact_quantiles(
        corrective, [key], "time_to_closure_hours", {"median": 0.5}, mean="mean", count="count"
    ).orderBy(F.col("mean").desc(), key)
    return stats.limit(limit) if limit else stats


def cost_by_portfolio(corrective: DataFrame) -> DataFrame:
    return (
        corrective.where(none_null(["portfolio"]))
        .groupBy("portfolio")
        .agg(_total("cout_total").alias("total"), F.avg("cout_total").alias("mean"), F.count("cout_total").alias("count"))
        .orderBy("portfolio")
    )


def cost_per_hour(corrective: DataFrame) -> DataFrame:
    """One row: mean and median cost per intervention hour over orders with a positive duration."""
    worked = corrective.where(F.col("duree_intervention_par_heure") > 0)
    rate = safe_ratio("cout_total", "duree_intervention_par_heure")
    return exact_quantiles(worked, [], rate, {"median_cost_per_hour": 0.5}, mean="avg_cost_per_hour", count="orders")


# --- features and flags ----------------------------------------------------------------------------------------------

def feature_profile(features: DataFrame, name: str) -> DataFrame:
    return describe(features, [], name)


def feature_histogram(features: DataFrame, name: str, bins: int = 50) -> DataFrame:
    return histogram(features, name, bins)


def positive_rates(features: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Share of positives (percent) per binary target."""
    rates = features.agg(*[(F.avg(name) * 100).alias(name) for name in targets])
    return rates.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("target"), F.col(n).alias("positive_rate_pct")) for n in targets]))
    )


def correlation_matrix(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of the chosen features as (feature_a, feature_b, correlation).

    Rows where either side is missing drop out of that pair.  One reading for any number of features.
    """
    return correlations(features, names)


def anomaly_cost_share(flagged: DataFrame, flag: str = "anomaly_consensus") -> DataFrame:
    """One row: number, cost and cost share of the flagged orders."""
    hit = F.col(flag) == 1
    return flagged.agg(
        F.count_if(hit).alias("anomalous_orders"),
        F.coalesce(F.sum(F.when(hit, F.col("cout_total"))), F.lit(0.0)).alias("anomaly_cost"),
        _total("cout_total").alias("total_cost"),
    ).withColumn("anomaly_cost_pct", percent("anomaly_cost", "total_cost"))


def improvement_actions(
    flagged: DataFrame, corrective: DataFrame, stock_overview: DataFrame, compliance: DataFrame
) -> DataFrame:
    """The six recommended actions with computed impact (half the anomaly cost, 30 % of the recurring cost)."""
    facts = with_summary(anomaly_cost_share(flagged), recurrence_summary(corrective).select("cost_3plus"))
    facts = with_summary(facts, stock_overview.select("stockout_pct"))
    facts = with_summary(facts, compliance.select("compliance_rate"))
    none = F.lit(None).cast("double")
    # Action codes, priorities and source labels of the report.
    rows = [
        ("review_anomalous_orders", F.col("anomaly_cost") * 0.5, "Haute", "Detection anomalies (IF+SVM)"),
        ("replace_recurring_assets", F.col("cost_3plus") * 0.3, "Haute", "Analyse equipements recurrents"),
        ("inspect_low_mtbf_families", none, "Moyenne", "Calcul MTBF par famille"),
        ("renegotiate_slow_providers", none, "Moyenne", "Performance prestataires"),
        ("safety_stock_pareto_articles", F.col("stockout_pct"), "Haute", "Analyse Pareto + ruptures"),
        ("track_preventive_compliance", F.col("compliance_rate"), "Haute", "Analyse conformite preventive"),
    ]
    return facts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).cast("long").alias("rank"),
                        F.lit(action).alias("action"),
                        impact.alias("impact"),
                        F.lit(priority).alias("priority"),
                        F.lit(source).alias("source"),
                    )
                    for i, (action, impact, priority, source) in enumerate(rows)
                ]
            )
        )
    )


def choice_lists(corrective: DataFrame, names: Sequence[str] = ("famille", "site", "urgence", "portfolio")) -> DataFrame:
    """Sorted distinct values of the selection columns as (column_name, value)."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("value")) for n in names])
    )
    return (
        corrective.select(pairs.alias("_pair"))
        .select("_pair.*")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("column_name", "value")
    )


def frequent_anomalies(corrective: DataFrame, limit: int = 25) -> DataFrame:
    return top_counts(corrective, "anomalie", limit)


def code_lookup(corrective: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_name, value, code) of the label encoding, by value rather than by row position."""
    result = None
    for name, lookup in category_codes(corrective, names).items():
        part = lookup.table.select(F.lit(name).alias("column_name"), F.col(name).alias("value"), "code")
        result = part if result is None else result.unionByName(part)
    return result.orderBy("column_name", "code")


def preview(df: DataFrame, rows: int = 100) -> DataFrame:
    """First rows of a table, as the dataset explorer shows them."""
    return df.limit(rows)
