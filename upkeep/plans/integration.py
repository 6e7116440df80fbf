"""Integration of the cleaned tables: part totals, asset master, timeline, locations, quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.expressions import none_null, present, text_or_nan, whole_days_between
from ..operators.frequency import duplicate_rows, modes
from ..operators.lookups import with_summary
from ..sources.readers import read_raw_tables
from ..sources.writers import write_table, write_timeline
from .cleaning import clean_corrective, clean_preventive, clean_spare_parts

ASSET_ATTRIBUTES = ("actif", "famille", "groupe", "site", "zone", "localisation")
PLACE = ("site", "zone")
REQUEST_ORDER = ("date_demande", "id_demande")


def part_totals(
    parts: DataFrame, order: Sequence[str] = REQUEST_ORDER, article_limit: int = 5, texts: bool = True
) -> DataFrame:
    """Per repair order: request count, quantity, cost, first articles, families and modal status.

    ``texts=False`` leaves the last three out, for callers that only need the numbers.
    """
    requests, quantity, cost = F.count("id_demande"), F.sum("quantite_demande"), F.sum("cout_total")
    outputs = ("num_spare_parts_requests", "total_parts_quantity", "total_parts_cost")
    if not texts:
        sums = parts.where(none_null(["id_ot"])).groupBy("id_ot").agg(
            requests.alias(outputs[0]),
            F.coalesce(quantity, F.lit(0.0)).alias(outputs[1]),
            F.coalesce(cost, F.lit(0.0)).alias(outputs[2]),
        )
        return sums.withColumnRenamed("id_ot", "id_ordre_travail")
    # One scan, one row per request.  Folded by (order, article, family, status), map side first, an order with very many
    # requests shrinks to its distinct lines before it meets in one place.  Within an order its id decides no place.
    place = [name for name in order if name != "id_ot"] or ["id_ot"]
    folded = (
        parts.where(none_null(["id_ot"]))
        .select(
            "id_ot", "id_demande", "quantite_demande", "cout_total", F.struct(*place).alias("_place"),
            text_or_nan("article").alias("_article"), text_or_nan("famille").alias("_famille"), F.col("etat").alias("_etat"),
        )
        .groupBy("id_ot", "_article", "_famille", "_etat")
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"), requests.alias("_requests"), quantity.alias("_quantity"), cost.alias("_cost"))
    )
    # Only here does a line count for its article, its family and its status: tagging, rank and last fold share one
    # exchange by order.
    tags = F.array(*[F.struct(F.lit(kind).alias("_kind"), F.col(f"_{kind}").alias("_value")) for kind in ("article", "famille", "etat")])
    measures = ("_n", "_requests", "_quantity", "_cost")
    tagged = folded.repartition("id_ot").select("id_ot", "_first", *measures, F.inline(tags))
    lines = tagged.groupBy("id_ot", "_kind", "_value").agg(F.min("_first").alias("_first"), *[F.sum(name).alias(name) for name in measures])
    place = Window.partitionBy("id_ot", "_kind").orderBy("_first", "_value")
    ranked = lines.withColumn("_rank", F.row_number().over(place))
    ranked = ranked.where((F.col("_kind") != "article") | (F.col("_rank") <= article_limit))

    def of(kind: str, value: str | Column) -> Column:
        return F.when(F.col("_kind") == kind, F.col(value) if isinstance(value, str) else value)

    def listed(kind: str) -> Column:
        found = F.sort_array(F.collect_list(of(kind, F.struct("_rank", "_value"))))
        return F.array_join(F.transform(found, lambda item: item["_value"]), ", ")

    known = F.when(F.col("_value").isNotNull(), F.struct(-F.col("_n"), F.col("_value")))
    return ranked.groupBy(F.col("id_ot").alias("id_ordre_travail")).agg(
        F.sum(of("etat", "_requests")).alias(outputs[0]),
        F.coalesce(F.sum(of("etat", "_quantity")), F.lit(0.0)).alias(outputs[1]),
        F.coalesce(F.sum(of("etat", "_cost")), F.lit(0.0)).alias(outputs[2]),
        listed("article").alias("parts_articles"),
        listed("famille").alias("parts_families"),
        F.min_by("_value", of("etat", known)).alias("parts_request_status"),
    )


def attach_parts(
    corrective: DataFrame, parts: DataFrame, order: Sequence[str] = REQUEST_ORDER, texts: bool = True
) -> DataFrame:
    """Left-join the part totals; orders without requests get zeros."""
    joined = corrective.join(part_totals(parts, order, texts=texts), "id_ordre_travail", "left")
    return joined.withColumns(
        {
            "num_spare_parts_requests": F.coalesce("num_spare_parts_requests", F.lit(0)).cast("long"),
            "total_parts_quantity": F.coalesce("total_parts_quantity", F.lit(0.0)),
            "total_parts_cost": F.coalesce("total_parts_cost", F.lit(0.0)),
        }
    )


def _both_kinds(corrective: DataFrame, preventive: DataFrame, columns: Sequence[str]) -> DataFrame:
    return corrective.select(*columns, F.lit("corrective").alias("source")).unionByName(
        preventive.select(*columns, F.lit("preventive").alias("source"))
    )


def _kind_counts() -> list:
    count = lambda kind: F.count_if(F.col("source") == kind)
    return [count("corrective").alias("corrective_count"), count("preventive").alias("preventive_count")]


def asset_master(corrective: DataFrame, preventive: DataFrame) -> DataFrame:
    """One row per asset: modal attributes, the kinds of order it has, and their counts."""
    rows = _both_kinds(corrective, preventive, ["id_actif", *ASSET_ATTRIBUTES])
    key = ["id_actif"]
    counts = rows.where(none_null(key)).groupBy(*key).agg(*_kind_counts())
    repaired, planned = F.col("corrective_count") > 0, F.col("preventive_count") > 0
    source = F.when(repaired & planned, "corrective, preventive").when(repaired, "corrective").otherwise("preventive")
    return (
        modes(rows, key, ASSET_ATTRIBUTES)
        .join(counts, key)
        .select(
            *key,
            *ASSET_ATTRIBUTES,
            source.alias("source"),
            "corrective_count",
            "preventive_count",
            (F.col("corrective_count") + F.col("preventive_count")).alias("total_maintenance_count"),
        )
    )


TIMELINE_COLUMNS = (
    "order_id", "date_created", "date_cloture", "etat", "description", "urgence", "site", "zone", "famille",
    "actif", "id_actif", "cout_total", "duree_intervention_par_heure", "prestataire", "num_spare_parts_requests",
    "total_parts_cost", "maintenance_type", "frequence",
)


def unified_timeline(corrective_integrated: DataFrame, preventive: DataFrame, ordered: bool = True) -> DataFrame:
    """Both kinds of order in one 18-column event table.

    ``ordered`` sorts by creation time (missing last, then kind and order id): a range-partitioned sort that a
    sink may skip.
    """
    repairs = corrective_integrated.select(
        F.col("id_ordre_travail").alias("order_id"),
        F.col("date_creation_ot").alias("date_created"),
        "date_cloture",
        "etat",
        F.col("anomalie").alias("description"),
        *["urgence", "site", "zone", "famille", "actif", "id_actif", "cout_total", "duree_intervention_par_heure"],
        *["prestataire", "num_spare_parts_requests", "total_parts_cost"],
        F.lit("corrective").alias("maintenance_type"),
        F.lit(None).cast("string").alias("frequence"),
    )
    duration = "intervention_duration_hours"
    planned = preventive.select(
        F.col("numero_ot").alias("order_id"),
        F.col("date_debut_planifiee").alias("date_created"),
        "date_cloture",
        "etat",
        F.col("nom_intervention").alias("description"),
        F.lit(None).cast("string").alias("urgence"),
        *["site", "zone", "famille", "actif", "id_actif"],
        F.col("cout").alias("cout_total"),
        (F.col(duration) if duration in preventive.columns else F.lit(None).cast("double")).alias(
            "duree_intervention_par_heure"
        ),
        "prestataire",
        F.lit(0).cast("long").alias("num_spare_parts_requests"),
        F.lit(0.0).alias("total_parts_cost"),
        F.lit("preventive").alias("maintenance_type"),
        "frequence",
    )
    timeline = repairs.select(*TIMELINE_COLUMNS).unionByName(planned.select(*TIMELINE_COLUMNS))
    if not ordered:
        return timeline
    return timeline.orderBy(F.col("date_created").asc_nulls_last(), "maintenance_type", "order_id")


def location_hierarchy(corrective: DataFrame, preventive: DataFrame) -> DataFrame:
    """Per (site, zone): distinct locations (a missing one counts), orders of both kinds and their total."""
    rows = _both_kinds(corrective, preventive, [*PLACE, "localisation"]).where(none_null(PLACE))
    # Two map-side combined levels: the places themselves are few and may be hot.
    per_location = rows.groupBy(*PLACE, "localisation").agg(*_kind_counts())
    return per_location.groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias("location_count"),
        F.sum("corrective_count").alias("corrective_count"),
        F.sum("preventive_count").alias("preventive_count"),
        F.sum(F.col("corrective_count") + F.col("preventive_count")).alias("total_maintenance"),
    )


def relationship_summary(integrated: DataFrame, assets: DataFrame, locations: DataFrame, timeline: DataFrame) -> DataFrame:
    """One row: part links, asset use, location spread and timeline facts."""
    linked = F.col("num_spare_parts_requests") > 0
    orders = integrated.agg(
        F.count_if(linked).alias("orders_with_parts"),
        (F.count_if(linked) * 100 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("orders_with_parts_pct"),
        F.avg(F.when(linked, F.col("num_spare_parts_requests"))).alias("avg_parts_per_order"),
        F.avg(F.when(linked, F.col("total_parts_cost"))).alias("avg_parts_cost_per_order"),
    )
    repaired, planned = F.col("corrective_count") > 0, F.col("preventive_count") > 0
    usage = assets.agg(
        F.count(F.lit(1)).alias("total_assets"),
        F.count_if(repaired & ~planned).alias("assets_corrective_only"),
        F.count_if(planned & ~repaired).alias("assets_preventive_only"),
        F.count_if(repaired & planned).alias("assets_both"),
        F.avg("total_maintenance_count").alias("avg_maintenance_per_asset"),
    )
    per_site = locations.groupBy("site").agg(
        F.sum("total_maintenance").alias("events"), F.count(F.lit(1)).alias("zones")
    )
    busiest = F.min_by(F.struct("site", "events"), F.struct(-F.col("events"), F.col("site")))
    places = per_site.agg(
        F.count(F.lit(1)).alias("total_sites"),
        F.sum("zones").alias("total_zones"),
        busiest["site"].alias("most_active_site"),
        busiest["events"].alias("most_active_site_count"),
    )
    events = timeline.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("maintenance_type") == "corrective").alias("corrective_events"),
        F.count_if(F.col("maintenance_type") == "preventive").alias("preventive_events"),
        whole_days_between(F.min("date_created"), F.max("date_created")).alias("date_range_days"),
    )
    summary = orders
    for block in (usage, places, events):
        summary = with_summary(summary, block)
    return summary


def data_quality_report(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Per column: missing count and percentage, type; plus table-wide row, column and duplicate counts.

    ``top`` keeps the columns with most missing values (the report's own limit); None lists all columns.
    """
    missing = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(_is_missing(f)).alias(f"missing_{i}") for i, f in enumerate(df.schema.fields)],
    )
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.col(f"missing_{i}").alias("missing_count"),
                )
                for i, f in enumerate(df.schema.fields)
            ]
        )
    )
    report = (
        missing.select("total_rows", rows)
        .withColumn("missing_pct", F.try_divide(F.col("missing_count") * 100.0, F.col("total_rows")))
        .withColumn("total_columns", F.lit(len(df.columns)).cast("long"))
        .withColumn("duplicates", duplicate_rows(df).scalar())
    )
    report = report.where(F.col("missing_count") > 0) if top else report
    ordered = report.orderBy(F.col("missing_count").desc(), "column_name")
    return ordered.limit(top) if top else ordered


def _is_missing(field: T.StructField):
    value = F.col("`" + field.name + "`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def integrate(corrective: DataFrame, preventive: DataFrame, parts: DataFrame) -> dict[str, DataFrame]:
    """The four integrated tables."""
    integrated = attach_parts(corrective, parts, present(parts, REQUEST_ORDER))
    return {
        "corrective_integrated": integrated,
        "asset_master": asset_master(corrective, preventive),
        "unified_timeline": unified_timeline(integrated, preventive, ordered=False),
        "location_hierarchy": location_hierarchy(corrective, preventive),
    }


def run_preprocessing(
    spark: SparkSession, raw_folder: str, processed_folder: str, csv: bool = False, multiline: bool = False
) -> dict[str, str]:
    """Read, clean, write, then integrate from the written (typed, columnar) tables; returns the paths.

    ``csv`` adds CSV twins; ``multiline`` is for CSV exports with line breaks in their texts.
    """
    raw = read_raw_tables(spark, raw_folder, multiline)
    cleaned = {
        "corrective_cleaned": clean_corrective(raw["corrective"]),
        "preventive_cleaned": clean_preventive(raw["preventive"]),
        "spare_parts_cleaned": clean_spare_parts(raw["spare_parts"]),
    }
    paths = {name: write_table(df, processed_folder, name, csv) for name, df in cleaned.items()}
    stored = {name: spark.read.parquet(path) for name, path in paths.items()}
    integrated = integrate(stored["corrective_cleaned"], stored["preventive_cleaned"], stored["spare_parts_cleaned"])
    for name, df in integrated.items():
        if name == "unified_timeline":
            paths[name] = write_timeline(df, processed_folder)
        else:
            paths[name] = write_table(df, processed_folder, name, csv)
    return paths
