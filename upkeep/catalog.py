"""Every operator as a named query over the supplied tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextvars import ContextVar
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions.expressions import quoted
from .operators.frequency import duplicate_rows
from .operators.lookups import with_summary
from .operators.quantiles import exact_quantiles
from .models import anomaly, classifiers, matrix, metrics, scoring, splits
from .models.boundary import fit_boundary
from .models.isolation import fit_forest
from .plans import cleaning, effectiveness as eff, exploration as ex, features as ft, integration as ig, spare_parts as sp
from .session import METHOD_LIMIT, materialize, spread, store
from .sources import star_tables as star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS, DECIMALS = 9, 6


def on_grid(value: Column) -> Column:
    """Nine significant digits, six decimals at most: what is left of a double whatever the order of addition.

    The odd offset keeps short decimals such as x.xxxx5 off the rounding border, where engines that add in
    different orders would disagree.
    """
    size = F.floor(F.log10(F.abs(value)))  # null for zero
    steps = F.pow(F.lit(10.0), F.coalesce(F.least(F.lit(DECIMALS), F.lit(DIGITS - 1) - size), F.lit(DECIMALS)).cast("double"))
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), value).otherwise(F.floor(value * steps + F.lit(0.5003)) / steps)


def presentable(df: DataFrame) -> DataFrame:
    """Doubles on a common grid and times without zone, for comparison and display."""
    columns = []
    for f in df.schema.fields:
        kind, value = f.dataType.typeName(), quoted(f.name)
        if kind == "double":
            value = on_grid(value)
        elif kind == "timestamp":
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set(*METHOD_LIMIT)
        return presentable(build(spark, folder))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


# The site that a dashboard is filtered to; None shows all.
SITE: ContextVar[str | None] = ContextVar("site", default=None)


def placed_orders(source, spark: SparkSession, folder: str, columns: str | Iterable[str]) -> DataFrame:
    columns = columns.split() if isinstance(columns, str) else list(columns)
    site = SITE.get()
    if site is None:
        return source(spark, folder, columns)
    return ex.at_site(source(spark, folder, dict.fromkeys([*columns, "site"])), site).select(*columns)


def repairs(spark: SparkSession, folder: str, columns: str | Iterable[str]) -> DataFrame:
    return placed_orders(star.corrective, spark, folder, columns)


def planned(spark: SparkSession, folder: str, columns: str | Iterable[str]) -> DataFrame:
    return placed_orders(star.preventive, spark, folder, columns)


def requests(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    return star.spare_parts(spark, folder, columns.split())


PLACED = "id_actif actif famille groupe site zone localisation"
PREVIEW = (
    f"id_ordre_travail {PLACED} portfolio etat urgence anomalie prestataire date_creation_ot date_cloture "
    "cout_total duree_intervention_par_heure time_to_closure_hours"
)


# --- cleaning and integration ---------------------------------------------------------------------------------

@query
def clean_corrective(spark, folder):
    return cleaning.clean_corrective(star.raw_corrective(spark, folder))


@query
def clean_preventive(spark, folder):
    return cleaning.clean_preventive(star.raw_preventive(spark, folder))


@query
def clean_spare_parts(spark, folder):
    return cleaning.clean_spare_parts(star.raw_spare_parts(spark, folder))


@query
def attach_parts(spark, folder):
    orders = repairs(spark, folder, "id_ordre_travail id_actif cout_total")
    parts = star.spare_parts(spark, folder)
    return ig.attach_parts(orders, parts, star.PART_ORDER)


@query
def asset_master(spark, folder):
    return ig.asset_master(repairs(spark, folder, PLACED), planned(spark, folder, PLACED))


TIMELINE_REPAIR = (
    "id_ordre_travail date_creation_ot date_cloture etat anomalie urgence site zone famille actif id_actif cout_total "
    "duree_intervention_par_heure prestataire"
)
TIMELINE_PLANNED = (
    "numero_ot date_debut_planifiee date_cloture etat nom_intervention frequence site zone famille actif id_actif "
    "cout prestataire intervention_duration_hours"
)


def timeline(spark, folder, ordered=False):
    parts = requests(spark, folder, "id_demande id_ot quantite_demande cout_total")
    orders = ig.attach_parts(repairs(spark, folder, TIMELINE_REPAIR), parts, texts=False)
    return ig.unified_timeline(orders, planned(spark, folder, TIMELINE_PLANNED), ordered)


def event_times(spark, folder):
    """Only what the volume reports read: kind and creation time of every order (of the chosen site)."""
    made = repairs(spark, folder, "id_ordre_travail date_creation_ot").select(
        F.col("date_creation_ot").alias("date_created"), F.lit("corrective").alias("maintenance_type")
    )
    plan = planned(spark, folder, "numero_ot date_debut_planifiee").select(
        F.col("date_debut_planifiee").alias("date_created"), F.lit("preventive").alias("maintenance_type")
    )
    return made.unionByName(plan)


@query
def unified_timeline(spark, folder):
    return timeline(spark, folder, ordered=True)


@query
def location_hierarchy(spark, folder):
    place = "site zone localisation"
    return ig.location_hierarchy(repairs(spark, folder, place), planned(spark, folder, place))


@query
def relationship_summary(spark, folder):
    parts = requests(spark, folder, "id_demande id_ot quantite_demande cout_total")
    made, plan = repairs(spark, folder, f"id_ordre_travail {PLACED}"), planned(spark, folder, PLACED)
    counts = made.select("id_actif", F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(
        plan.select("id_actif", F.lit(0).alias("c"), F.lit(1).alias("p"))
    )
    assets = counts.groupBy("id_actif").agg(
        F.sum("c").alias("corrective_count"), F.sum("p").alias("preventive_count"), F.count("*").alias("total_maintenance_count")
    )
    return ig.relationship_summary(
        ig.attach_parts(made.select("id_ordre_travail"), parts, texts=False),
        assets,
        ig.location_hierarchy(made, plan),
        event_times(spark, folder),
    )


@query
def data_quality_report(spark, folder):
    """All columns of the three tables."""
    tables = {"corrective": star.corrective, "preventive": star.preventive, "parts": star.spare_parts}
    reports = [
        ig.data_quality_report(source(spark, folder), top=None).withColumn("table_name", F.lit(name))
        for name, source in tables.items()
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def duplicate_part_lines(spark, folder):
    """Rows that repeat another in every column."""
    return duplicate_rows(star.spare_parts(spark, folder))


# --- features ---------------------------------------------------------------------------------------------------

BASE = "id_ordre_travail id_actif date_creation_ot"


@query
def time_features(spark, folder):
    return ft.time_features(repairs(spark, folder, BASE))


@query
def equipment_features(spark, folder):
    df = repairs(spark, folder, f"{BASE} famille cout_total duree_intervention_par_heure")
    return ft.equipment_features(df).drop("duree_intervention_par_heure", "cout_total")


@query
def location_features(spark, folder):
    return ft.location_features(repairs(spark, folder, "id_ordre_travail site zone cout_total"))


def integrated(spark, folder, columns):
    parts = requests(spark, folder, "id_demande id_ot quantite_demande cout_total")
    return ig.attach_parts(repairs(spark, folder, columns), parts, texts=False)


@query
def spare_parts_features(spark, folder):
    return ft.spare_parts_features(integrated(spark, folder, "id_ordre_travail famille cout_total"))


@query
def anomaly_features(spark, folder):
    """Flags summed to one column, because the flag names depend on the data."""
    df = ft.anomaly_features(repairs(spark, folder, f"{BASE} anomalie"))
    flags = [n for n in df.columns if n.startswith("anomaly_") and n != "anomaly_recurrence_count"]
    own = F.lit(0)
    for name in flags:
        own = own + quoted(name)
    return df.select("id_ordre_travail", "anomalie", own.alias("flags_set"), "anomaly_recurrence_count")


@query
def urgency_features(spark, folder):
    return ft.urgency_features(repairs(spark, folder, "id_ordre_travail famille urgence"))


@query
def anomaly_flag_rows(spark, folder):
    """The flags of the frequent anomaly types, one row for each that is set."""
    return ft.anomaly_flag_rows(repairs(spark, folder, "id_ordre_travail anomalie"))


@query
def urgency_flag_rows(spark, folder):
    return ft.flag_rows(repairs(spark, folder, "id_ordre_travail urgence"), "urgence")


@query
def provider_features(spark, folder):
    return ft.provider_features(repairs(spark, folder, "id_ordre_travail prestataire cout_total time_to_closure_hours"))


@query
def rolling_features(spark, folder):
    return ft.rolling_features(repairs(spark, folder, f"{BASE} cout_total"))


@query
def rolling_features_time(spark, folder):
    return ft.rolling_features_time(repairs(spark, folder, f"{BASE} cout_total"))


@query
def encode_categoricals(spark, folder):
    return ft.encode_categoricals(repairs(spark, folder, "id_ordre_travail portfolio site zone famille groupe prestataire etat"))


@query
def create_targets(spark, folder):
    df = integrated(spark, folder, f"{BASE} anomalie duree_intervention_par_heure")
    return ft.create_targets(df.withColumn("has_spare_parts", (F.col("num_spare_parts_requests") > 0).cast("long")))


FEATURE_INPUT = (
    f"{BASE} famille groupe site zone portfolio etat urgence anomalie prestataire cout_total cout_maindoeuvre "
    "nombre_main_doeuvre duree_intervention_par_heure time_to_closure_hours time_to_start_hours"
)


def features(spark, folder) -> DataFrame:
    """Feature table over the stored integrated orders, as in the pipeline, where one step reads the other's table."""
    return ft.feature_table(store(integrated(spark, folder, FEATURE_INPUT))[0])


@query
def feature_table(spark, folder):
    """All features; the data-dependent anomaly flags are summed to one column."""
    df = features(spark, folder)
    flags = ft.flag_columns(df)
    own = F.lit(0)
    for name in flags:
        own = own + quoted(name)
    return df.withColumn("flags_set", own).drop(*flags)


@query
def feature_groups(spark, folder):
    return ft.feature_groups(features(spark, folder))


# --- effectiveness ------------------------------------------------------------------------------------------------

@query
def compare_maintenance_types(spark, folder):
    return eff.compare_maintenance_types(
        repairs(spark, folder, "id_actif cout_total duree_intervention_par_heure"),
        planned(spark, folder, "id_actif cout date_debut date_cloture"),
    )


def labour_costs(spark, folder):
    return eff.with_labour_costs(
        repairs(spark, folder, f"{BASE} date_cloture"),
        planned(spark, folder, "numero_ot id_actif date_debut date_cloture"),
        requests(spark, folder, "id_ot cout_total"),
    )


@query
def compare_labour_costs(spark, folder):
    return eff.compare_labour_costs(*labour_costs(spark, folder))


def families(spark, folder):
    return eff.effectiveness_by_family(
        repairs(spark, folder, "id_ordre_travail famille cout_total"), planned(spark, folder, "numero_ot famille cout")
    )


@query
def effectiveness_by_family(spark, folder):
    return families(spark, folder)


@query
def best_and_worst_families(spark, folder):
    table = families(spark, folder)
    best = eff.ranked_families(table).withColumn("side", F.lit("top"))
    return best.unionByName(eff.ranked_families(table, best=False).withColumn("side", F.lit("bottom")))


@query
def calculate_roi(spark, folder):
    return eff.calculate_roi(repairs(spark, folder, "id_actif cout_total"), planned(spark, folder, "id_actif cout"))


@query
def roi_by_family(spark, folder):
    return eff.roi_by_family(families(spark, folder))


INTERVAL_PLANNED = "numero_ot id_actif date_debut"


def intervals(spark, folder):
    return eff.maintenance_intervals(repairs(spark, folder, BASE), planned(spark, folder, INTERVAL_PLANNED))


@query
def maintenance_intervals(spark, folder):
    return intervals(spark, folder)


@query
def recommended_interval(spark, folder):
    return eff.recommended_interval(intervals(spark, folder))


@query
def signal_intervals(spark, folder):
    """The same as-of join over the event stream, whose times are unique to the microsecond."""
    return eff.maintenance_intervals(*star.asset_signals(spark, folder))


@query
def preventive_compliance(spark, folder):
    return eff.preventive_compliance(planned(spark, folder, "numero_ot days_deviation_from_plan"))


@query
def compliance_by_site(spark, folder):
    return eff.compliance_by(planned(spark, folder, "numero_ot site date_debut date_debut_planifiee"), "site")


@query
def deviation_by_frequency(spark, folder):
    return eff.deviation_by_frequency(planned(spark, folder, "frequence days_deviation_from_plan"))


@query
def preventive_status_distribution(spark, folder):
    return eff.status_distribution(planned(spark, folder, "numero_ot etat"), "etat")


@query
def preventive_frequency_distribution(spark, folder):
    return eff.status_distribution(planned(spark, folder, "numero_ot frequence"), "frequence")


def labels(spark, folder):
    return eff.effectiveness_labels(
        repairs(spark, folder, BASE), planned(spark, folder, f"{INTERVAL_PLANNED} famille cout date_cloture")
    )


@query
def effectiveness_labels(spark, folder):
    return labels(spark, folder)


@query
def effective_share(spark, folder):
    return labels(spark, folder).agg(
        F.count("*").alias("planned_orders"), F.avg(F.col("is_effective").cast("double")).alias("effective_share")
    )


@query
def monthly_trend(spark, folder):
    return eff.monthly_trend(*labour_costs(spark, folder))


@query
def recommendations(spark, folder):
    made, plan = labour_costs(spark, folder)
    roi = eff.calculate_roi(repairs(spark, folder, "id_actif cout_total"), planned(spark, folder, "id_actif cout"))
    return eff.recommendations(
        roi,
        eff.recommended_interval(intervals(spark, folder)),
        families(spark, folder),
        made.agg(F.avg("total_cost").alias("mean")),
        plan.agg(F.avg("total_cost").alias("mean")),
    )


@query
def effectiveness_summary(spark, folder):
    return eff.effectiveness_summary(
        repairs(spark, folder, f"{BASE} famille cout_total duree_intervention_par_heure"),
        planned(spark, folder, "numero_ot id_actif famille cout date_debut date_cloture days_deviation_from_plan"),
    )


# --- spare parts -----------------------------------------------------------------------------------------------------

@query
def pareto_analysis(spark, folder):
    return sp.pareto_analysis(requests(spark, folder, "id_demande article cout_total quantite_demande"))


@query
def pareto_set(spark, folder):
    return sp.pareto_set(sp.pareto_analysis(requests(spark, folder, "id_demande article cout_total quantite_demande")))


@query
def consumption_by_family(spark, folder):
    return sp.consumption_by_family(requests(spark, folder, "famille cout_total quantite_demande"))


@query
def demand_forecast(spark, folder):
    return sp.demand_forecast(star.spare_parts(spark, folder), order=star.PART_ORDER)


@query
def reorder_analysis(spark, folder):
    return sp.reorder_analysis(star.spare_parts(spark, folder), order=star.PART_ORDER)


@query
def stock_out_cost_by_family(spark, folder):
    return sp.stock_out_cost_by_family(requests(spark, folder, "famille quantite_dispo cout_total"))


@query
def stock_out_overview(spark, folder):
    return sp.stock_out_overview(requests(spark, folder, "famille quantite_dispo cout_total"))


@query
def stock_health_summary(spark, folder):
    parts = requests(spark, folder, "article famille quantite_dispo quantite_demande cout_total etat")
    return sp.stock_health_summary(parts).drop("top_stockout_families")


@query
def top_stock_out_families(spark, folder):
    return sp.top_stock_out_families(requests(spark, folder, "famille quantite_dispo quantite_demande"))


@query
def stock_by_family(spark, folder):
    return sp.stock_by_family(requests(spark, folder, "famille quantite_dispo"))


@query
def rejection_reasons(spark, folder):
    return sp.rejection_reasons(requests(spark, folder, "etat motif_rejet"))


@query
def rejections_by_family(spark, folder):
    return sp.rejections_by_family(requests(spark, folder, "etat famille"))


@query
def spare_parts_summary(spark, folder):
    return sp.spare_parts_summary(star.spare_parts(spark, folder), star.PART_ORDER).drop("top_stockout_families")


# --- exploration --------------------------------------------------------------------------------------------------------

@query
def daily_volume(spark, folder):
    return ex.daily_volume(event_times(spark, folder))


@query
def daily_volume_profile(spark, folder):
    return ex.daily_volume_profile(event_times(spark, folder))


@query
def weekday_volume(spark, folder):
    return ex.weekday_volume(event_times(spark, folder))


@query
def hourly_volume(spark, folder):
    """By hour of day; the event table has real clock times."""
    events = star.table(spark, folder, "events")
    kinds = F.when(F.col("event_type") == "error", "corrective").when(F.col("event_type") == "view", "preventive")
    return ex.hourly_volume(events.select(F.col("ts").alias("date_created"), kinds.alias("maintenance_type")))


@query
def busiest_times(spark, folder):
    events = star.table(spark, folder, "events")
    return ex.busiest_times(events.select(F.col("ts").alias("date_created")))


@query
def overview(spark, folder):
    made, plan = repairs(spark, folder, "id_actif"), planned(spark, folder, "id_actif")
    assets = made.union(plan).where("id_actif is not null").distinct()
    return ex.overview(made, plan, assets, event_times(spark, folder))


@query
def dataset_preview(spark, folder):
    """The first corrective orders, as the dataset explorer shows them."""
    return ex.preview(repairs(spark, folder, PREVIEW).orderBy("id_ordre_travail"))


@query
def top_anomaly_types(spark, folder):
    return ex.top_anomaly_types(repairs(spark, folder, "anomalie"))


@query
def top_families(spark, folder):
    return ex.top_counts(repairs(spark, folder, "famille"), "famille", 10)


@query
def status_distribution(spark, folder):
    return ex.distribution(repairs(spark, folder, "etat"), "etat")


@query
def urgency_distribution(spark, folder):
    return ex.distribution(repairs(spark, folder, "urgence"), "urgence")


@query
def mtbf_by_family(spark, folder):
    return ex.mtbf_by_family(repairs(spark, folder, f"{BASE} famille"))


@query
def failures_by_site(spark, folder):
    return ex.failure_hotspots(repairs(spark, folder, "site urgence cout_total"))


@query
def failures_by_zone(spark, folder):
    return ex.failure_hotspots(repairs(spark, folder, "site zone urgence cout_total"), ("site", "zone"))


@query
def recurrence_summary(spark, folder):
    return ex.recurrence_summary(repairs(spark, folder, "id_actif cout_total est_reouvert"))


@query
def top_recurring_assets(spark, folder):
    return ex.top_recurring_assets(repairs(spark, folder, "id_ordre_travail id_actif famille site cout_total"))


PROVIDER = "id_ordre_travail prestataire time_to_closure_hours cout_total duree_intervention_par_heure"


@query
def provider_performance(spark, folder):
    return ex.provider_performance(repairs(spark, folder, PROVIDER))


@query
def provider_spread(spark, folder):
    return ex.provider_spread(repairs(spark, folder, PROVIDER))


@query
def closure_time_summary(spark, folder):
    return ex.closure_time_summary(repairs(spark, folder, "time_to_closure_hours duree_intervention_par_heure"))


@query
def closure_time_histogram(spark, folder):
    return ex.closure_time_histogram(repairs(spark, folder, "time_to_closure_hours"))


@query
def feature_profile(spark, folder):
    return ex.feature_profile(repairs(spark, folder, "cout_total"), "cout_total")


@query
def feature_histogram(spark, folder):
    return ex.feature_histogram(repairs(spark, folder, "cout_total"), "cout_total")


@query
def positive_rates(spark, folder):
    targets = ["will_fail_within_30_days", "will_need_spare_parts"]
    df = integrated(spark, folder, f"{BASE} anomalie duree_intervention_par_heure")
    made = ft.create_targets(df.withColumn("has_spare_parts", (F.col("num_spare_parts_requests") > 0).cast("long")))
    return ex.positive_rates(made, targets)


@query
def correlation_matrix(spark, folder):
    names = ["cout_total", "duree_intervention_par_heure", "nombre_main_doeuvre", "time_to_closure_hours"]
    return ex.correlation_matrix(repairs(spark, folder, names), names)


def plain_numbers(df: DataFrame) -> list[str]:
    """Numeric features whose names do not depend on the data."""
    own = set(ft.flag_columns(df))
    return [name for name in matrix.numeric_inputs(df) if name not in own]


@query
def feature_correlations(spark, folder):
    """Every pair of numeric features of the feature table as it is presented."""
    rows = presentable(features(spark, folder))
    return ex.correlation_matrix(rows, plain_numbers(rows))


@query
def cost_by_portfolio(spark, folder):
    return ex.cost_by_portfolio(repairs(spark, folder, "portfolio cout_total"))


@query
def cost_per_hour(spark, folder):
    return ex.cost_per_hour(repairs(spark, folder, "cout_total duree_intervention_par_heure"))


@query
def closure_time_by_urgency(spark, folder):
    return ex.closure_time_by(repairs(spark, folder, "urgence time_to_closure_hours"), "urgence")


@query
def closure_time_by_family(spark, folder):
    return ex.closure_time_by(repairs(spark, folder, "famille time_to_closure_hours"), "famille", 10)


def flagged(spark, folder, columns=""):
    """Orders with two rule-made flags, the deterministic input of the consensus reports."""
    needed = f"id_ordre_travail cout_total duree_intervention_par_heure time_to_closure_hours {columns}"
    return repairs(spark, folder, needed).withColumns(
        {
            "iso_anomaly": F.coalesce((F.col("cout_total") > 450000).cast("long"), F.lit(0)),
            "ocsvm_anomaly": F.coalesce((F.col("duree_intervention_par_heure") > 180).cast("long"), F.lit(0)),
        }
    )


@query
def choice_lists(spark, folder):
    return ex.choice_lists(repairs(spark, folder, "famille site urgence portfolio"))


@query
def frequent_anomalies(spark, folder):
    return ex.frequent_anomalies(repairs(spark, folder, "anomalie"))


@query
def code_lookup(spark, folder):
    return ex.code_lookup(repairs(spark, folder, "site famille portfolio"), ["site", "famille", "portfolio"])




# --- reports on anomaly flags -------------------------------------------------------------------------------------------

@query
def evaluate_anomalies(spark, folder):
    return anomaly.evaluate_anomalies(anomaly.anomaly_consensus(flagged(spark, folder)))


@query
def compare_anomaly_groups(spark, folder):
    return anomaly.compare_groups(anomaly.anomaly_consensus(flagged(spark, folder)))


@query
def compare_anomaly_groups_wide(spark, folder):
    """The five measures: those of the orders, and their parts."""
    rows = anomaly.anomaly_consensus(flagged(spark, folder))
    parts = requests(spark, folder, "id_demande id_ot quantite_demande cout_total")
    return anomaly.compare_groups(ig.attach_parts(rows, parts, texts=False), anomaly.COMPARED_WIDE)


@query
def anomaly_profile(spark, folder):
    return anomaly.anomaly_profile(flagged(spark, folder, "site portfolio urgence etat"))


@query
def anomaly_rate_by_site(spark, folder):
    return anomaly.anomaly_rate_by(flagged(spark, folder, "site"))


@query
def method_overlap(spark, folder):
    return anomaly.method_overlap(flagged(spark, folder))


@query
def flag_correlations(spark, folder):
    names = ["cout_total", "duree_intervention_par_heure", "time_to_closure_hours", "nombre_main_doeuvre"]
    return anomaly.flag_correlations(flagged(spark, folder, "nombre_main_doeuvre"), names)


@query
def anomaly_cost_share(spark, folder):
    return ex.anomaly_cost_share(anomaly.anomaly_consensus(flagged(spark, folder)))


@query
def improvement_actions(spark, folder):
    return ex.improvement_actions(
        anomaly.anomaly_consensus(flagged(spark, folder)),
        repairs(spark, folder, "id_actif cout_total est_reouvert"),
        sp.stock_out_overview(requests(spark, folder, "famille quantite_dispo cout_total")),
        eff.preventive_compliance(planned(spark, folder, "numero_ot days_deviation_from_plan")),
    )


# --- models ------------------------------------------------------------------------------------------------------------------

MEASURES = ["cout_total", "duree_intervention_par_heure", "time_to_closure_hours", "time_to_start_hours"]


def measures(spark, folder) -> DataFrame:
    return repairs(spark, folder, ["id_ordre_travail", *MEASURES])


def scaled_measures(spark, folder) -> tuple[DataFrame, list[str]]:
    rows = spread(materialize(measures(spark, folder)))
    scaler = matrix.Standardizer.fit(rows, MEASURES)
    scaled = rows.select("id_ordre_travail", *scaler.columns())
    return scaled, [f"x{i}" for i in range(len(MEASURES))]


@query
def standardized_inputs(spark, folder):
    """Median fill and scaling of the model inputs."""
    return scaled_measures(spark, folder)[0]


@query
def model_matrix(spark, folder):
    """Zero-filled, scaled vectors of all numeric features."""
    rows = features(spark, folder)
    names = matrix.numeric_inputs(rows)
    rows = materialize(rows.select("id_ordre_travail", *map(quoted, names)))  # read by the fit and by the result
    scaled, _ = matrix.model_matrix(rows, names)
    return scaled.select("id_ordre_travail", F.size(classifiers.vector_to_array("scaled")).alias("inputs"))


def scaled_features(spark, folder) -> tuple[DataFrame, list[str]]:
    """The sixteen inputs of the ensemble, filled and scaled."""
    inputs = list(anomaly.ANOMALY_FEATURES)
    rows = spread(materialize(features(spark, folder).select("id_ordre_travail", *inputs)))
    scaler = matrix.Standardizer.fit(rows, inputs)
    return rows.select("id_ordre_travail", *scaler.columns()), [f"x{i}" for i in range(len(inputs))]


@query
def isolation_forest(spark, folder):
    scaled, names = scaled_features(spark, folder)
    forest = fit_forest(scaled, "id_ordre_travail", names)
    return scaled.select("id_ordre_travail", forest.score_column(spark, names).alias("iso_score"))


@query
def one_class_boundary(spark, folder):
    scaled, names = scaled_features(spark, folder)
    model = fit_boundary(scaled, names)
    score = model.score_column(names) - F.lit(model.rho)
    return scaled.select("id_ordre_travail", score.alias("ocsvm_score")).withColumn(
        "ocsvm_anomaly", (F.col("ocsvm_score") < 0).cast("long")
    )


@query
def anomaly_detector(spark, folder):
    """Both methods on the sixteen features of the feature table, with consensus."""
    rows = materialize(features(spark, folder).select("id_ordre_travail", *anomaly.ANOMALY_FEATURES))
    model = anomaly.AnomalyDetector().fit(rows)
    return model.transform(rows).select(
        "id_ordre_travail", "iso_score", "iso_anomaly", "ocsvm_score", "ocsvm_anomaly", "anomaly_consensus", "anomaly_confidence"
    )


@query
def failure_model(spark, folder):
    return classifiers.train_failure_model(features(spark, folder)).metrics


@query
def failure_importances(spark, folder):
    """Of the same model; cross-validation would not change it."""
    settings = replace(classifiers.FAILURE_SETTINGS, folds=0)
    return classifiers.train_failure_model(features(spark, folder), settings).classifier.importances()


@query
def parts_model(spark, folder):
    return classifiers.train_parts_model(features(spark, folder)).metrics


@query
def parts_importances(spark, folder):
    """Of the same model, with one fit instead of six."""
    settings = replace(classifiers.PARTS_SETTINGS, folds=0)
    return classifiers.train_parts_model(features(spark, folder), settings).classifier.importances()


@query
def effectiveness_model(spark, folder):
    trained = classifiers.train_effectiveness_model(labels(spark, folder))
    return trained.metrics if trained else spark.createDataFrame([], classifiers.METRICS_SCHEMA)


@query
def score_orders(spark, folder):
    """Every repair order re-entered as a new, partly described one and scored by the three models."""
    orders = materialize(integrated(spark, folder, FEATURE_INPUT))
    table = materialize(ft.feature_table(orders))
    failure = classifiers.train_failure_model(table, replace(classifiers.FAILURE_SETTINGS, folds=0))
    parts = classifiers.train_parts_model(table, replace(classifiers.PARTS_SETTINGS, folds=0))
    ensemble = anomaly.AnomalyDetector().fit(table)
    profile = scoring.ScoringProfile.fit(orders, table)
    return scoring.score_orders(new_orders(orders), profile, failure.classifier, parts.classifier, ensemble).drop(
        "previous_failures", "days_since_last_maintenance"
    )


def new_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        *"id_ordre_travail site famille portfolio urgence anomalie cout_total duree_intervention_par_heure".split(),
        "nombre_main_doeuvre",
        F.hour("date_creation_ot").alias("creation_hour"),
        F.weekday("date_creation_ot").alias("creation_day_of_week"),
        F.lit(1).alias("previous_failures"),
        F.lit(15.0).alias("days_since_last_maintenance"),
        "date_creation_ot",
    )


@query
def order_factors(spark, folder):
    """The ten strongest inputs of the failure model beside every order, with the value used."""
    orders = materialize(integrated(spark, folder, FEATURE_INPUT))
    table = materialize(ft.feature_table(orders))
    failure = classifiers.train_failure_model(table, replace(classifiers.FAILURE_SETTINGS, folds=0))
    return scoring.order_factors(new_orders(orders), scoring.ScoringProfile.fit(orders, table), failure.classifier)


#: Inputs of a completed order: given, computed from what is given, from the history of its family and site, and codes.
COMPLETED = (
    "cout_total creation_hour creation_month creation_quarter creation_is_weekend creation_is_business_hours "
    "equipment_failure_count equipment_age_days famille_avg_cost famille_failure_count famille_spare_parts_usage_rate "
    "site_failure_count anomaly_recurrence_count cout_maindoeuvre time_to_closure_hours time_to_start_hours "
    "rolling_7d_failures rolling_30d_avg_cost urgence_Fort site_encoded famille_encoded portfolio_encoded zone_encoded"
).split()


@query
def scoring_inputs(spark, folder):
    """What the models see of the orders that ``score_orders`` and ``order_factors`` complete, as rows."""
    orders = materialize(integrated(spark, folder, FEATURE_INPUT))
    profile = scoring.ScoringProfile.fit(orders, materialize(ft.feature_table(orders)))
    return scoring.completed_inputs(new_orders(orders), profile, COMPLETED)


# --- what must hold of every fitted model, as rows that SQL can know --------------------------------------------------

#: Smaller models that learn from the same rows in the same way; what is checked does not depend on their size.
CHECKED_FOREST = replace(classifiers.FAILURE_SETTINGS, trees=10, depth=6, folds=0)
CHECKED_BOOSTED = replace(classifiers.PARTS_SETTINGS, trees=5, depth=4, folds=0)


def training_check(trained: classifiers.Training) -> DataFrame:
    """Rows and positives learnt from, rows held out, and how far the metrics are from a plain count of the predictions."""
    cells = trained.predictions.agg(
        F.count("*").alias("test_rows"),
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 1)).alias("_tp"),
        F.count_if(F.col("prediction") == 1).alias("_called"),
        F.count_if(F.col("label") == 1).alias("test_positives"),
        F.count_if(F.col("probability").between(0, 1)).alias("_sound"),
    )
    gap = lambda value, part, whole: F.coalesce(F.abs(F.col(value) - F.col(part) / F.nullif(F.col(whole), F.lit(0))), F.lit(0.0))
    both = with_summary(trained.metrics, cells)
    return both.select(
        "target",
        "n_samples",
        "positive_rate",
        "test_rows",
        "test_positives",
        (F.col("_sound") == F.col("test_rows")).alias("probabilities_sound"),
        F.greatest(gap("test_precision", "_tp", "_called"), gap("test_recall", "_tp", "test_positives")).alias("metrics_gap"),
    )


@query
def failure_model_check(spark, folder):
    return training_check(classifiers.train_failure_model(features(spark, folder), CHECKED_FOREST))


@query
def parts_model_check(spark, folder):
    return training_check(classifiers.train_parts_model(features(spark, folder), CHECKED_BOOSTED))


@query
def effectiveness_model_check(spark, folder):
    return training_check(classifiers.train_effectiveness_model(labels(spark, folder), replace(classifiers.EFFECTIVENESS_SETTINGS, trees=10, folds=0)))


@query
def failure_importances_check(spark, folder):
    """Importances add up to one, and none is negative."""
    rows = features(spark, folder)
    rows = rows.select("id_ordre_travail", "will_fail_within_30_days", *plain_numbers(rows))
    return importances_check(classifiers.train_failure_model(rows, CHECKED_FOREST))


@query
def parts_importances_check(spark, folder):
    """Likewise, without the inputs that give the answer away."""
    rows = features(spark, folder)
    rows = rows.select("id_ordre_travail", "will_need_spare_parts", *plain_numbers(rows))
    return importances_check(classifiers.train_parts_model(rows, CHECKED_BOOSTED))


def importances_check(trained: classifiers.Training) -> DataFrame:
    return trained.classifier.importances(1000).agg(
        F.count("*").alias("inputs"), F.sum("importance").alias("total"), F.count_if(F.col("importance") < 0).alias("negative"),
        F.max("rank").alias("last_rank"),
    )


@query
def model_matrix_values(spark, folder):
    """Zero-filled and scaled values of the sixteen ensemble inputs, as rows."""
    names = list(anomaly.ANOMALY_FEATURES)
    rows = materialize(features(spark, folder).select("id_ordre_travail", *names))
    scaled, _ = matrix.model_matrix(rows, names)
    values = classifiers.vector_to_array("scaled")
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), values[i].alias("value")) for i, n in enumerate(names)])
    return scaled.select("id_ordre_travail", F.inline(pairs))


@query
def isolation_forest_check(spark, folder):
    """Scores for all orders, all within bounds, and a tenth of the orders below the tenth quantile."""
    scored = materialize(QUERIES["isolation_forest"](spark, folder))
    cut = exact_quantiles(scored, [], "iso_score", {"cut": 0.1})
    return with_summary(scored, cut).agg(
        F.count("iso_score").alias("orders"), F.count_if(F.abs("iso_score") > 1).alias("out_of_bounds"),
        F.count_if(F.col("iso_score") < F.col("cut")).alias("flagged"),
    )


@query
def one_class_boundary_check(spark, folder):
    scored = QUERIES["one_class_boundary"](spark, folder)
    return scored.agg(F.count("ocsvm_score").alias("orders"), F.sum("ocsvm_anomaly").alias("flagged"))


@query
def anomaly_detector_check(spark, folder):
    """Both flags, and that consensus and confidence follow from them."""
    rows = QUERIES["anomaly_detector"](spark, folder)
    iso, svm = F.col("iso_anomaly"), F.col("ocsvm_anomaly")
    return rows.agg(
        F.count("*").alias("orders"), F.sum(iso).alias("iso_flagged"), F.sum(svm).alias("boundary_flagged"),
        F.count_if((F.col("anomaly_consensus") != F.greatest(iso, svm)) | (F.col("anomaly_confidence") != iso + svm)).alias("contradictions"),
    )


@query
def principal_components_check(spark, folder):
    """Projected rows are centred and uncorrelated."""
    rows = QUERIES["principal_components"](spark, folder)
    return rows.agg(
        F.count("pc1").alias("orders"), F.round(F.abs(F.avg("pc1")) + F.abs(F.avg("pc2")), 4).alias("offset"),
        F.round(F.abs(F.corr("pc1", "pc2")), 4).alias("correlation"),
    )


@query
def explained_variance_check(spark, folder):
    """The shares are those of the spread of the projected rows in the spread of all scaled inputs."""
    scaled, names = scaled_features(spark, folder)
    whole = scaled.agg(sum(F.var_samp(n) for n in names).alias("whole"))
    axes = with_summary(QUERIES["explained_variance"](spark, folder), whole)
    return axes.agg(
        F.count("*").alias("axes"), F.max_by("share", F.col("axis")).alias("_second"), F.min_by("share", F.col("axis")).alias("_first"),
        F.max(F.abs(F.col("variance") / F.col("whole") - F.col("share"))).alias("_gap"),
    ).select("axes", (F.col("_first") >= F.col("_second")).alias("ordered"), F.round("_gap", 4).alias("gap"))


def rule_predictions(spark, folder, cost: int = 250000) -> DataFrame:
    """Label, score and class by rule, the deterministic input of the quality measures."""
    rows = repairs(spark, folder, "id_ordre_travail urgence cout_total duree_intervention_par_heure")
    score = F.coalesce(F.col("duree_intervention_par_heure"), F.lit(0.0)) / 500
    return rows.select(
        "id_ordre_travail",
        (F.col("urgence") == "Fort").cast("int").alias("label"),
        score.alias("probability"),
        (F.col("cout_total") > cost).cast("int").alias("prediction"),
    )


@query
def classification_metrics(spark, folder):
    return metrics.classification_metrics(rule_predictions(spark, folder))


@query
def headline_metrics(spark, folder):
    """The dashboard's figures of a model summary; the predictions are those of two rules, the flags those of ``flagged``."""
    summary = anomaly.evaluate_anomalies(anomaly.anomaly_consensus(flagged(spark, folder)))
    for name, cost in (("failure_prediction", 250000), ("spare_parts_prediction", 150000)):
        measured = metrics.classification_metrics(rule_predictions(spark, folder, cost))
        scores = F.struct(F.col("f1").alias("test_f1"), F.col("roc_auc").alias("test_roc_auc"))
        summary = with_summary(summary, measured.select(scores.alias(name)))
    return ex.headline_metrics(summary.withColumn("anomaly_detection", F.struct("consensus_anomalies", "agreement_pct")))


@query
def classification_report(spark, folder):
    return metrics.classification_report(rule_predictions(spark, folder))


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(rule_predictions(spark, folder))


@query
def stratified_split(spark, folder):
    """Sizes of the test part and of the folds per label."""
    split = splits.stratify(rule_predictions(spark, folder), "label", "id_ordre_travail")
    return split.groupBy("label", "fold").agg(F.count("*").alias("orders")).unionByName(
        split.where("is_test").groupBy("label").agg(F.lit(-1).alias("fold"), F.count("*").alias("orders"))
    )


@query
def principal_components(spark, folder):
    rows, _ = matrix.project(features(spark, folder), anomaly.ANOMALY_FEATURES, ["id_ordre_travail"])
    return rows


@query
def explained_variance(spark, folder):
    """Share of the variance that each axis of the projection explains, as the spread of the projected rows."""
    rows, shares = matrix.project(features(spark, folder), anomaly.ANOMALY_FEATURES, ["id_ordre_travail"])
    axes = F.inline(
        F.array(*[F.struct(F.lit(i + 1).alias("axis"), F.lit(s).alias("share"), F.col(f"pc{i + 1}").alias("place")) for i, s in enumerate(shares)])
    )
    return rows.select(axes).groupBy("axis", "share").agg(F.var_samp("place").alias("variance"))


# --- the exploration reports behind the site filter -------------------------------------------------------------------

SITE_REPORTS = (
    "top_anomaly_types top_families status_distribution urgency_distribution mtbf_by_family failures_by_zone "
    "recurrence_summary top_recurring_assets provider_performance provider_spread closure_time_summary "
    "closure_time_histogram cost_by_portfolio cost_per_hour closure_time_by_urgency closure_time_by_family "
    "evaluate_anomalies compare_anomaly_groups anomaly_profile anomaly_cost_share daily_volume daily_volume_profile "
    "weekday_volume overview"
).split()
REPORT_SITE = "EUROPE"


def at_report_site(report: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        token = SITE.set(REPORT_SITE)
        try:
            return report(spark, folder)
        finally:
            SITE.reset(token)

    return run


QUERIES |= {f"{name}_at_site": at_report_site(QUERIES[name]) for name in SITE_REPORTS}
