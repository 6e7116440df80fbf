"""Preventive-maintenance effectiveness: comparison, scores, ROI, intervals, compliance, trends, advice."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expressions import (
    guarded_ratio,
    hours_between,
    none_null,
    percent,
    safe_ratio,
    whole_days_between,
    year_month,
)
from ..operators.frequency import unpivot_row, value_counts
from ..operators.lookups import with_summary
from ..operators.ordered import next_match
from ..operators.quantiles import exact_quantiles
from ..operators.slicing import DEFAULT_POLICY, SlicePolicy
from ..session import materialize
from ..sources.readers import read_table
from ..sources.writers import write_summary, write_table

FAMILY, ASSET = "famille", "id_actif"
HOURLY_LABOUR_RATE = 50.0
LOW_SCORE = 30.0
COST_ALERT_RATIO = 2.0


def _cost_column(preventive: DataFrame) -> str:
    return "cout" if "cout" in preventive.columns else "cout_total"


def _preventive_hours(preventive: DataFrame) -> Column:
    if {"date_debut", "date_cloture"} <= set(preventive.columns):
        return hours_between("date_debut", "date_cloture")
    if "intervention_duration_hours" in preventive.columns:
        return F.col("intervention_duration_hours")
    return F.lit(None).cast("double")


def _planned_time(preventive: DataFrame) -> str:
    return "date_debut" if "date_debut" in preventive.columns else "date_debut_planifiee"


# --- comparison ---------------------------------------------------------------------------------------------

COMPARISON_METRICS = (
    "total_interventions", "avg_duration_hours", "median_duration_hours", "avg_cost", "total_cost",
    "unique_equipment",
)


def _kind_summary(rows: DataFrame, hours: Column, cost: str, prefix: str) -> DataFrame:
    basics = rows.agg(
        F.count(F.lit(1)).alias(f"{prefix}_total_interventions"),
        F.avg(cost).alias(f"{prefix}_avg_cost"),
        F.coalesce(F.sum(cost), F.lit(0.0)).alias(f"{prefix}_total_cost"),
        F.count_distinct(ASSET).alias(f"{prefix}_unique_equipment"),
    )
    duration = exact_quantiles(
        rows, [], hours, {f"{prefix}_median_duration_hours": 0.5}, mean=f"{prefix}_avg_duration_hours"
    )
    return with_summary(basics, duration)


def compare_maintenance_types(corrective: DataFrame, preventive: DataFrame) -> DataFrame:
    """Six metrics x (corrective, preventive, ratio); the ratio is NULL for a zero preventive value."""
    repairs = _kind_summary(corrective, F.col("duree_intervention_par_heure"), "cout_total", "corrective")
    planned = _kind_summary(preventive, _preventive_hours(preventive), _cost_column(preventive), "preventive")
    rows = {
        name: {
            "corrective": f"corrective_{name}",
            "preventive": f"preventive_{name}",
            "ratio": safe_ratio(f"corrective_{name}", f"preventive_{name}"),
        }
        for name in COMPARISON_METRICS
    }
    return unpivot_row(with_summary(repairs, planned), rows)


def with_labour_costs(
    corrective: DataFrame, preventive: DataFrame, parts: DataFrame, rate: float = HOURLY_LABOUR_RATE
) -> tuple[DataFrame, DataFrame]:
    """Costing from hours: keep positive durations, labour = hours x rate, repairs also pay for their parts."""
    per_order = parts.where(F.col("id_ot").isNotNull()).groupBy(F.col("id_ot").alias("id_ordre_travail")).agg(
        F.coalesce(F.sum("cout_total"), F.lit(0.0)).alias("parts_cost")
    )
    repairs = (
        corrective.withColumn("duration_hours", hours_between("date_creation_ot", "date_cloture"))
        .where(F.col("duration_hours") > 0)
        .join(per_order, "id_ordre_travail", "left")
        .withColumn("parts_cost", F.coalesce("parts_cost", F.lit(0.0)))
        .withColumn("total_cost", F.col("duration_hours") * rate + F.col("parts_cost"))
    )
    planned = (
        preventive.withColumn("duration_hours", hours_between(_planned_time(preventive), "date_cloture"))
        .where(F.col("duration_hours") > 0)
        .withColumn("total_cost", F.col("duration_hours") * rate)
    )
    return repairs, planned


def compare_labour_costs(repairs: DataFrame, planned: DataFrame) -> DataFrame:
    """Second comparison, on costed orders: six metrics and the difference in percent of preventive."""

    def summary(rows: DataFrame, prefix: str, parts: Column) -> DataFrame:
        count = F.count(F.lit(1))
        return rows.agg(
            count.alias(f"{prefix}_total_interventions"),
            F.avg("duration_hours").alias(f"{prefix}_avg_duration_hours"),
            F.avg("total_cost").alias(f"{prefix}_avg_cost"),
            F.coalesce(F.sum("total_cost"), F.lit(0.0)).alias(f"{prefix}_total_cost"),
            parts.alias(f"{prefix}_avg_parts_cost"),
            safe_ratio(count, F.count_distinct(ASSET)).alias(f"{prefix}_interventions_per_equipment"),
        )

    names = (
        "total_interventions", "avg_duration_hours", "avg_cost", "total_cost", "avg_parts_cost",
        "interventions_per_equipment",
    )
    both = with_summary(
        summary(repairs, "corrective", F.avg("parts_cost")), summary(planned, "preventive", F.lit(0.0))
    )
    rows = {
        name: {
            "corrective": f"corrective_{name}",
            "preventive": f"preventive_{name}",
            "difference_pct": percent(
                F.col(f"corrective_{name}") - F.col(f"preventive_{name}"), f"preventive_{name}"
            ),
        }
        for name in names
    }
    return unpivot_row(both, rows)


# --- families and ROI ------------------------------------------------------------------------------------------

def effectiveness_score(cost_ratio: Column, intervention_ratio: Column) -> Column:
    """200 / (1 + cost ratio + intervention ratio): 0 to 200, higher is better; an unknown ratio counts as 1."""
    return F.lit(200.0) / (F.lit(1.0) + F.coalesce(cost_ratio, F.lit(1.0)) + F.coalesce(intervention_ratio, F.lit(1.0)))


def effectiveness_by_family(corrective: DataFrame, preventive: DataFrame) -> DataFrame:
    """Counts, costs, ratios and score of the families that have both kinds of order, best first."""
    cost = _cost_column(preventive)

    def per_family(rows: DataFrame, order_id: str, amount: str, prefix: str) -> DataFrame:
        return rows.where(none_null([FAMILY])).groupBy(FAMILY).agg(
            F.count(order_id).alias(f"{prefix}_count"),
            F.avg(amount).alias(f"{prefix}_avg_cost"),
            F.coalesce(F.sum(amount), F.lit(0.0)).alias(f"{prefix}_total_cost"),
        )

    both = per_family(corrective, "id_ordre_travail", "cout_total", "corr").join(
        per_family(preventive, "numero_ot", cost, "prev"), FAMILY
    )
    ratios = both.withColumns(
        {
            "cost_ratio": safe_ratio("corr_avg_cost", "prev_avg_cost"),
            "intervention_ratio": safe_ratio("corr_count", "prev_count"),
        }
    )
    score = effectiveness_score(F.col("cost_ratio"), F.col("intervention_ratio"))
    return ratios.withColumn("effectiveness_score", score).orderBy(F.col("effectiveness_score").desc(), FAMILY)


def ranked_families(families: DataFrame, count: int = 3, best: bool = True) -> DataFrame:
    """The best (or worst) scoring families."""
    score = F.col("effectiveness_score")
    return families.select(FAMILY, "effectiveness_score").orderBy(score.desc() if best else score.asc(), FAMILY).limit(count)


def calculate_roi(corrective: DataFrame, preventive: DataFrame, avoidance_factor: float = 0.6) -> DataFrame:
    """One row: investment, avoided cost, net benefit and ROI in percent (0 without investment)."""
    cost = _cost_column(preventive)
    invested = preventive.agg(
        F.coalesce(F.sum(cost), F.lit(0.0)).alias("preventive_investment"), F.count_distinct(ASSET).alias("_assets")
    )
    per_asset = corrective.where(none_null([ASSET])).groupBy(ASSET).agg(
        F.coalesce(F.sum("cout_total"), F.lit(0.0)).alias("_cost")
    )
    joined = with_summary(invested, per_asset.agg(F.avg("_cost").alias("_mean")))
    avoided = F.col("_mean") * F.col("_assets") * F.lit(avoidance_factor)
    return joined.select("preventive_investment", avoided.alias("estimated_cost_avoided")).select(
        "*", (F.col("estimated_cost_avoided") - F.col("preventive_investment")).alias("net_benefit")
    ).withColumn("roi_percent", guarded_ratio("net_benefit", "preventive_investment") * 100)


def roi_by_family(families: DataFrame, avoidance_factor: float = 0.6) -> DataFrame:
    """ROI per family from :func:`effectiveness_by_family` rows, best first."""
    avoided = F.col("corr_total_cost") * F.lit(avoidance_factor)
    roi = guarded_ratio(avoided - F.col("prev_total_cost"), "prev_total_cost") * 100
    return families.select(
        FAMILY,
        F.col("prev_total_cost").alias("preventive_cost"),
        F.col("corr_total_cost").alias("corrective_cost"),
        avoided.alias("estimated_avoided"),
        roi.alias("roi_percent"),
    ).orderBy(F.col("roi_percent").desc(), FAMILY)


# --- intervals ---------------------------------------------------------------------------------------------------

def maintenance_intervals(
    corrective: DataFrame, preventive: DataFrame, policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Each planned order and the strictly next failure of its asset, with the completed days in between."""
    start = _planned_time(preventive)
    matched = next_match(
        preventive.select(ASSET, "numero_ot", start),
        corrective.select(ASSET, "date_creation_ot"),
        ASSET,
        start,
        "numero_ot",
        "date_creation_ot",
        "next_corrective_date",
        policy=policy,
    )
    return matched.where(F.col("next_corrective_date").isNotNull()).select(
        ASSET,
        "numero_ot",
        F.col(start).alias("preventive_date"),
        "next_corrective_date",
        whole_days_between(start, "next_corrective_date").alias("days_until_failure"),
    )


def recommended_interval(intervals: DataFrame, share: float = 0.75) -> DataFrame:
    """One row: interpolated quantile of the intervals and their number (no row when there are none)."""
    intervals = materialize(intervals.select("days_until_failure"))  # read twice
    return exact_quantiles(intervals, [], "days_until_failure", {"optimal_interval_days": share}, count="intervals")


def effectiveness_labels(
    corrective: DataFrame, preventive: DataFrame, window_days: int = 90, policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Planned orders of assets that also failed: effective when no failure follows within ``window_days`` days.

    The family is the one on the asset's first planned order.
    """
    start = _planned_time(preventive)
    matched = next_match(
        preventive.select(
            ASSET,
            "numero_ot",
            start,
            _preventive_hours(preventive).alias("prev_duration"),
            F.col(_cost_column(preventive)).alias("prev_cost"),
        ),
        corrective.select(ASSET, "date_creation_ot"),
        ASSET,
        start,
        "numero_ot",
        "date_creation_ot",
        "next_corrective_date",
        key_has_match="_failed",
        policy=policy,
    ).where("_failed")
    days = whole_days_between(start, "next_corrective_date")
    first_family = preventive.where(none_null([ASSET])).groupBy(ASSET).agg(
        F.min_by(FAMILY, F.struct(F.col(start).isNull(), F.col(start), F.col("numero_ot"))).alias(FAMILY)
    )
    labelled = matched.withColumn("is_effective", F.coalesce(days > window_days, F.lit(True)))
    # One family row per asset on the other side; AQE splits a hot asset's partition of this join.
    return labelled.join(first_family, ASSET, "left").select(
        ASSET, "numero_ot", FAMILY, "prev_duration", "prev_cost", "is_effective"
    )


# --- compliance -------------------------------------------------------------------------------------------------

def preventive_compliance(preventive: DataFrame, tolerance_days: float = 1.0) -> DataFrame:
    """One row: share of planned orders started within the tolerance, mean and median deviation, counts.

    Without a deviation column the row holds NULLs.
    """
    name = "days_deviation_from_plan"
    if name not in preventive.columns:
        return preventive.limit(0).agg(
            F.sum(F.lit(None).cast("double")).alias("compliance_rate"),
            F.sum(F.lit(None).cast("double")).alias("avg_deviation_days"),
        )
    known = preventive.where(F.col(name).isNotNull())
    counts = known.agg(
        F.count(F.lit(1)).alias("total_with_data"), F.count_if(F.abs(name) <= tolerance_days).alias("on_time_count")
    )
    spread = exact_quantiles(known, [], name, {"median_deviation_days": 0.5}, mean="avg_deviation_days")
    return with_summary(counts, spread).select(
        F.coalesce(percent("on_time_count", "total_with_data"), F.lit(0.0)).alias("compliance_rate"),
        "avg_deviation_days",
        "median_deviation_days",
        "on_time_count",
        "total_with_data",
    )


def compliance_by(preventive: DataFrame, key: str, tolerance_days: float = 1.0) -> DataFrame:
    """On-time share per site (or any key), from the two start times."""
    deviation = hours_between("date_debut_planifiee", "date_debut") / 24
    known = preventive.select(key, deviation.alias("_d")).where(F.col("_d").isNotNull() & none_null([key]))
    return known.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.abs("_d") <= tolerance_days).alias("on_time")
    ).withColumn("rate", F.round(percent("on_time", "total"), 1))


def deviation_by_frequency(preventive: DataFrame) -> DataFrame:
    """Mean, median and count of the plan deviation per maintenance frequency."""
    return exact_quantiles(
        preventive, ["frequence"], "days_deviation_from_plan", {"median": 0.5}, mean="mean", count="count"
    )


def status_distribution(orders: DataFrame, column: str = "etat") -> DataFrame:
    return value_counts(orders, column).orderBy(F.col("count").desc(), column)


# --- trend and advice ----------------------------------------------------------------------------------------------

def monthly_trend(repairs: DataFrame, planned: DataFrame) -> DataFrame:
    """Per month and kind: orders, total cost, mean duration; input from :func:`with_labour_costs`."""

    def monthly(rows: DataFrame, time: str, kind: str) -> DataFrame:
        return (
            rows.where(F.col(time).isNotNull())
            .groupBy(year_month(time).alias("year_month"))
            .agg(
                F.count(F.lit(1)).alias("n_interventions"),
                F.coalesce(F.sum("total_cost"), F.lit(0.0)).alias("total_cost"),
                F.avg("duration_hours").alias("avg_duration"),
            )
            .withColumn("maintenance_type", F.lit(kind))
        )

    return monthly(repairs, "date_creation_ot", "Corrective").unionByName(
        monthly(planned, _planned_time(planned), "Preventive")
    )


def recommendations(
    roi: DataFrame, interval: DataFrame, families: DataFrame, mean_corrective_cost: DataFrame, mean_preventive_cost: DataFrame
) -> DataFrame:
    """Ordered advice derived from the one-row summaries (fixed wording)."""
    facts = with_summary(roi.select("roi_percent"), interval.select("optimal_interval_days"))
    low = families.agg(F.count_if(F.col("effectiveness_score") < LOW_SCORE).alias("low_families"))
    facts = with_summary(facts, low)
    facts = with_summary(facts, mean_corrective_cost.select(F.col(mean_corrective_cost.columns[0]).alias("corr_mean")))
    facts = with_summary(facts, mean_preventive_cost.select(F.col(mean_preventive_cost.columns[0]).alias("prev_mean")))
    days = F.format_string("%d", F.bround("optimal_interval_days").cast("long"))
    texts = F.array(
        F.when(
            F.col("roi_percent") > 0, "Continue and expand preventive maintenance programs (positive ROI)"
        ).otherwise("Optimize preventive maintenance schedules to improve ROI"),
        F.when(
            F.col("optimal_interval_days").isNotNull(),
            F.concat(F.lit("Implement preventive maintenance every "), days, F.lit(" days")),
        ),
        F.when(
            F.col("low_families") > 0,
            F.concat(
                F.lit("Focus improvement efforts on "),
                F.col("low_families").cast("string"),
                F.lit(" low-performing equipment families"),
            ),
        ),
        F.when(
            F.col("corr_mean") > F.col("prev_mean") * COST_ALERT_RATIO,
            "Increase preventive maintenance frequency to reduce high corrective costs",
        ),
    )
    listed = facts.select(F.posexplode(F.filter(texts, lambda t: t.isNotNull())).alias("rank", "recommendation"))
    return listed.select((F.col("rank") + 1).cast("long").alias("rank"), "recommendation")


def effectiveness_summary(corrective: DataFrame, preventive: DataFrame) -> DataFrame:
    """One row with every headline number of the effectiveness reports."""
    comparison = compare_maintenance_types(corrective, preventive)
    flat = comparison.agg(
        *[
            F.max(F.when(F.col("metric") == name, F.col(side))).alias(f"{side}_{name}")
            for name in COMPARISON_METRICS
            for side in ("corrective", "preventive", "ratio")
        ]
    )
    families = effectiveness_by_family(corrective, preventive)
    summary = with_summary(calculate_roi(corrective, preventive), preventive_compliance(preventive))
    interval = recommended_interval(maintenance_intervals(corrective, preventive))
    summary = with_summary(summary, interval.select("optimal_interval_days"))
    summary = with_summary(summary, families.agg(F.count(F.lit(1)).alias("n_families_analyzed")))
    return with_summary(summary, flat)


def run_effectiveness(spark: SparkSession, processed_folder: str, reports_folder: str) -> Mapping[str, str]:
    """Write comparison, families, intervals and the JSON summary; returns the paths."""
    corrective = read_table(
        spark, processed_folder, "corrective_integrated", ("date_creation_ot", "date_cloture", "date_declaration")
    )
    preventive = read_table(
        spark, processed_folder, "preventive_cleaned", ("date_debut_planifiee", "date_debut", "date_fin", "date_cloture")
    )
    tables = {
        "maintenance_comparison": compare_maintenance_types(corrective, preventive),
        "family_effectiveness": effectiveness_by_family(corrective, preventive),
        "maintenance_intervals": maintenance_intervals(corrective, preventive),
    }
    paths = {name: write_table(df, reports_folder, name, csv=True) for name, df in tables.items()}
    paths["effectiveness_summary"] = write_summary(
        effectiveness_summary(corrective, preventive), reports_folder, "effectiveness_summary"
    )
    return paths
