"""Adapters: the maintenance tables derived from the supplied star-schema and event tables.

``orders`` become repair orders (status O and P) and planned orders (status F) of an asset (the customer),
``lineitem`` becomes part requests.  A caller names the columns it needs, and joins that feed none of them are
left out.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expressions import ORDER_TIME_FORMAT, REQUEST_TIME_FORMAT

_LINE_COLUMNS = {
    "date_cloture",
    "date_debut_reparation",
    "date_debut_planifiee",
    "date_fin",
    "duree_intervention_par_heure",
    "nombre_main_doeuvre",
    "cout_maindoeuvre",
    "est_reouvert",
    "prestataire",
    "anomalie",
    "nom_intervention",
    "time_to_closure_hours",
    "time_to_start_hours",
    "days_deviation_from_plan",
    "intervention_duration_hours",
}
_PART_COLUMNS = {"anomalie", "nom_intervention"}
_SUPPLIER_COLUMNS = {"prestataire"}
_CUSTOMER_COLUMNS = {"actif", "famille", "groupe", "localisation", "site", "zone"}
_PLACE_COLUMNS = {"site", "zone", "groupe"}

CORRECTIVE_COLUMNS = (
    "id_ordre_travail id_actif actif famille groupe site zone localisation portfolio etat urgence anomalie "
    "prestataire date_declaration date_creation_ot date_debut_reparation date_cloture cout_total "
    "cout_maindoeuvre nombre_main_doeuvre duree_intervention_par_heure est_reouvert time_to_closure_hours "
    "time_to_start_hours"
).split()
PREVENTIVE_COLUMNS = (
    "numero_ot id_actif actif famille groupe site zone localisation etat frequence nom_intervention prestataire "
    "date_debut_planifiee date_debut date_fin date_cloture cout days_deviation_from_plan "
    "intervention_duration_hours"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table with zone-less times read as UTC timestamps."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in times}) if times else df


def _enriched_orders(spark: SparkSession, folder: str, statuses: list[str], wanted: set[str]) -> DataFrame:
    rows = table(spark, folder, "orders").where(F.col("o_orderstatus").isin(statuses))
    if wanted & _CUSTOMER_COLUMNS:
        customer = table(spark, folder, "customer")
        if wanted & _PLACE_COLUMNS:
            # nation and region are the fixed 25- and 5-row dictionaries of the star schema.
            places = table(spark, folder, "nation").join(
                table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
            )
            customer = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        rows = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    if wanted & _LINE_COLUMNS:
        lines = table(spark, folder, "lineitem")
        if wanted & _PART_COLUMNS:
            lines = lines.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        aggregates = {
            "first_ship": F.min("l_shipdate"),
            "last_ship": F.max("l_shipdate"),
            "quantity": F.sum("l_quantity"),
            "lines": F.count(F.lit(1)),
            "returned": F.bool_or(F.col("l_returnflag") == "R"),
            "supplier_key": F.min("l_suppkey"),
        }
        if wanted & _PART_COLUMNS:
            aggregates["part_name"] = F.min("p_name")
        per_order = lines.groupBy("l_orderkey").agg(*[a.alias(n) for n, a in aggregates.items()])
        if wanted & _SUPPLIER_COLUMNS:
            supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
            per_order = per_order.join(supplier, F.col("supplier_key") == F.col("s_suppkey"), "left")
        rows = rows.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows


def _choose(rows: DataFrame, expressions: dict[str, Column], columns: Iterable[str]) -> DataFrame:
    return rows.select(*[expressions[name].alias(name) for name in columns])


def _hours(start: str, end: str) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)


def corrective(spark: SparkSession, folder: str, columns: Iterable[str] = CORRECTIVE_COLUMNS) -> DataFrame:
    columns = list(columns)
    rows = _enriched_orders(spark, folder, ["O", "P"], set(columns))
    c = F.col
    urgency = (
        F.when(c("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Fort")
        .when(c("o_orderpriority") == "3-MEDIUM", "Moyen")
        .otherwise("Faible")
    )
    return _choose(
        rows,
        {
            "id_ordre_travail": c("o_orderkey"),
            "id_actif": c("o_custkey"),
            "actif": c("c_name"),
            "famille": c("c_mktsegment"),
            "groupe": F.concat(c("r_name"), F.lit("/"), c("c_mktsegment")),
            "site": c("r_name"),
            "zone": c("n_name"),
            "localisation": c("c_name"),
            "portfolio": c("o_orderpriority"),
            "etat": c("o_orderstatus"),
            "urgence": urgency,
            "anomalie": c("part_name"),
            "prestataire": c("s_name"),
            "date_declaration": c("o_orderdate"),
            "date_creation_ot": c("o_orderdate"),
            "date_debut_reparation": c("first_ship"),
            "date_cloture": c("last_ship"),
            "cout_total": c("o_totalprice"),
            "cout_maindoeuvre": c("quantity") * 50,
            "nombre_main_doeuvre": c("lines"),
            "duree_intervention_par_heure": c("quantity"),
            "est_reouvert": c("returned"),
            "time_to_closure_hours": _hours("o_orderdate", "last_ship"),
            "time_to_start_hours": _hours("o_orderdate", "first_ship"),
        },
        columns,
    )


def preventive(spark: SparkSession, folder: str, columns: Iterable[str] = PREVENTIVE_COLUMNS) -> DataFrame:
    columns = list(columns)
    rows = _enriched_orders(spark, folder, ["F"], set(columns))
    c = F.col
    return _choose(
        rows,
        {
            "numero_ot": c("o_orderkey"),
            "id_actif": c("o_custkey"),
            "actif": c("c_name"),
            "famille": c("c_mktsegment"),
            "groupe": F.concat(c("r_name"), F.lit("/"), c("c_mktsegment")),
            "site": c("r_name"),
            "zone": c("n_name"),
            "localisation": c("c_name"),
            "etat": c("o_orderstatus"),
            "frequence": c("o_orderpriority"),
            "nom_intervention": c("part_name"),
            "prestataire": c("s_name"),
            "date_debut_planifiee": c("first_ship"),
            "date_debut": c("o_orderdate"),
            "date_fin": c("last_ship"),
            "date_cloture": c("last_ship"),
            "cout": c("o_totalprice"),
            "days_deviation_from_plan": _hours("first_ship", "o_orderdate") / 24,
            "intervention_duration_hours": _hours("o_orderdate", "last_ship"),
        },
        columns,
    )


SPARE_PARTS_COLUMNS = (
    "id_demande id_ot article code_article famille magasinier quantite_demande quantite_dispo cout_total etat "
    "motif_rejet date_demande"
).split()
PART_ORDER = ("date_demande", "id_ot", "id_demande", "code_article", "magasinier")


def spare_parts(spark: SparkSession, folder: str, columns: Iterable[str] = SPARE_PARTS_COLUMNS) -> DataFrame:
    columns = list(columns)
    rows = table(spark, folder, "lineitem")
    if {"famille", "quantite_dispo"} & set(columns):
        rows = rows.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    c = F.col
    rejected = c("l_returnflag") == "R"
    return _choose(
        rows,
        {
            "id_demande": c("l_linenumber").cast("long"),
            "id_ot": c("l_orderkey"),
            "article": c("l_partkey").cast("string"),
            "code_article": c("l_partkey"),
            "famille": c("p_type") if "p_type" in rows.columns else F.lit(None),
            "magasinier": c("l_suppkey"),
            "quantite_demande": c("l_quantity"),
            "quantite_dispo": (c("p_size") - 1).cast("long") if "p_size" in rows.columns else F.lit(None),
            "cout_total": c("l_extendedprice"),
            "etat": F.when(rejected, "rejet").otherwise("valide"),
            "motif_rejet": F.when(rejected, F.concat(F.lit("motif "), c("l_linenumber").cast("string"))),
            "date_demande": c("l_shipdate"),
        },
        columns,
    )


def asset_signals(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(failures, inspections) of the event stream: ``error`` and ``view`` events of one user = asset."""
    events = table(spark, folder, "events")

    def kind(name: str) -> DataFrame:
        return events.where(F.col("event_type") == name)

    failures = kind("error").select(
        F.col("event_id").alias("id_ordre_travail"),
        F.col("user_id").alias("id_actif"),
        F.col("ts").alias("date_creation_ot"),
        F.col("value").alias("cout_total"),
    )
    inspections = kind("view").select(
        F.col("event_id").alias("numero_ot"),
        F.col("user_id").alias("id_actif"),
        F.col("ts").alias("date_debut"),
        F.col("value").alias("cout"),
    )
    return failures, inspections


def raw_corrective(spark: SparkSession, folder: str) -> DataFrame:
    """Repair orders in export form: seven text times (some unusable), four Oui/Non flags, four costs, some missing."""
    rows = _enriched_orders(spark, folder, ["O", "P"], {"date_cloture"})
    c = F.col
    text = lambda name: F.date_format(name, "dd/MM/yyyy HH:mm")
    yes_no = lambda yes, no="Non": F.when(yes, "Oui").when(~yes, no)
    return rows.select(
        c("o_orderkey").alias("id_ordre_travail"),
        F.when(c("o_orderstatus") == "O", "Clotur\ufffd").otherwise("Ouvert").alias("etat"),
        text("o_orderdate").alias("date_declaration"),
        F.date_format("o_orderdate", ORDER_TIME_FORMAT).alias("date_creation_ot"),
        F.when(c("o_orderpriority") == "5-LOW", "non renseigne").otherwise(text("first_ship")).alias(
            "date_debut_reparation"
        ),
        text("last_ship").alias("date_cloture"),
        F.when(c("returned"), text("last_ship")).otherwise("").alias("date_reouverture"),
        F.when(c("o_orderstatus") == "O", text("first_ship")).otherwise("31/02/2024 10:00").alias("date_validation"),
        F.lit(None).cast("string").alias("date_rejet"),
        yes_no(c("returned"), "non").alias("est_reouvert"),
        yes_no(c("o_orderpriority") == "1-URGENT").alias("vandalisme"),
        F.when(c("o_orderpriority") != "5-LOW", yes_no(c("lines") > 3)).alias("palliative"),
        F.when(c("lines") > 0, "oui").otherwise("?").alias("avec_demande_pdr"),
        F.when(c("o_orderpriority") != "3-MEDIUM", c("o_totalprice")).alias("cout_total"),
        F.when(c("lines") > 1, c("quantity") * 50).otherwise(F.lit(float("nan"))).alias("cout_maindoeuvre"),
        F.when(c("returned"), c("quantity")).alias("cout_pdr"),
        F.lit(None).cast("double").alias("cout_bc"),
    )


def raw_preventive(spark: SparkSession, folder: str) -> DataFrame:
    """Planned orders in export form: six text times, ISO and day first, missing costs."""
    rows = _enriched_orders(spark, folder, ["F"], {"date_cloture"})
    c = F.col
    # Day first where no month could be meant; other days would be read month first, as the cleaning step defines.
    day_first = lambda name: F.when(F.dayofmonth(name) > 12, F.date_format(name, "dd/MM/yyyy HH:mm")).otherwise(
        F.date_format(name, "yyyy-MM-dd HH:mm")
    )
    return rows.select(
        c("o_orderkey").alias("numero_ot"),
        F.date_format("first_ship", "yyyy-MM-dd HH:mm:ss").alias("date_debut_planifiee"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_debut"),
        F.date_format("last_ship", "yyyy-MM-dd'T'HH:mm:ss").alias("date_fin"),
        F.when(c("lines") > 1, day_first("last_ship")).otherwise("unknown").alias("date_fin_planifiee"),
        F.when(c("o_orderpriority") != "5-LOW", day_first("last_ship")).alias("date_cloture"),
        F.date_format("first_ship", "yyyy-MM-dd").alias("date_validation"),
        F.when(c("o_orderpriority") != "3-MEDIUM", c("o_totalprice")).alias("cout"),
    )


def raw_spare_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Part requests in export form: text times, zero and missing quantities."""
    c = F.col
    ship = c("l_shipdate")
    return table(spark, folder, "lineitem").select(
        c("l_orderkey").alias("id_ot"),
        c("l_linenumber").cast("long").alias("id_demande"),
        c("l_partkey").alias("code_article"),
        c("l_suppkey").alias("magasinier"),
        F.date_format(ship, REQUEST_TIME_FORMAT).alias("date_demande"),
        F.date_format(ship + F.make_dt_interval(days=F.lit(0), hours=c("l_linenumber")), "dd/MM/yyyy, HH:mm:ss").alias(
            "date_validation_superviseur"
        ),
        F.when(
            c("l_returnflag") != "R",
            F.date_format(ship + F.make_dt_interval(days=c("l_linenumber")), "dd/MM/yyyy, HH:mm:ss"),
        ).alias("date_cloture"),
        F.when(c("l_returnflag") == "R", F.date_format(ship, "dd/MM/yyyy, HH:mm:ss")).otherwise("-").alias("date_rejet"),
        F.when(c("l_linestatus") == "O", c("l_quantity")).when(c("l_linenumber") > 2, F.lit(0.0)).alias(
            "quantite_demande"
        ),
        c("l_extendedprice").alias("cout_total"),
    )
