"""SQL twins of the catalog queries, for comparison in another engine over the same tables."""

from __future__ import annotations

# --- the maintenance tables as common table expressions ----------------------------------------------------------

LINES = """lines AS (
  SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, sum(l_quantity) AS quantity,
         count(*) AS line_count, bool_or(l_returnflag = 'R') AS returned, min(l_suppkey) AS supplier_key,
         min(p_name) AS part_name
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
)"""

ORDERS = f"""{LINES}, placed AS (
  SELECT *, date_diff('microsecond', o_orderdate, last_ship) / 3.6e9 AS close_hours,
         date_diff('microsecond', o_orderdate, first_ship) / 3.6e9 AS start_hours
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey LEFT JOIN lines ON o_orderkey = l_orderkey
  LEFT JOIN (SELECT s_suppkey, s_name FROM supplier) ON supplier_key = s_suppkey
)"""

C = f"""{ORDERS}, corrective AS (
  SELECT o_orderkey AS id_ordre_travail, o_custkey AS id_actif, c_name AS actif, c_mktsegment AS famille,
         r_name || '/' || c_mktsegment AS groupe, r_name AS site, n_name AS zone, c_name AS localisation,
         o_orderpriority AS portfolio, o_orderstatus AS etat,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Fort'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'Moyen' ELSE 'Faible' END AS urgence,
         part_name AS anomalie, s_name AS prestataire, o_orderdate AS date_creation_ot, last_ship AS date_cloture,
         o_totalprice AS cout_total, quantity * 50 AS cout_maindoeuvre, line_count AS nombre_main_doeuvre,
         quantity AS duree_intervention_par_heure, returned AS est_reouvert, close_hours AS time_to_closure_hours,
         start_hours AS time_to_start_hours, o_orderdate AS date_declaration, first_ship AS date_debut_reparation
  FROM placed WHERE o_orderstatus IN ('O', 'P')
)"""

CP = f"""{C}, preventive AS (
  SELECT o_orderkey AS numero_ot, o_custkey AS id_actif, c_name AS actif, c_mktsegment AS famille,
         r_name || '/' || c_mktsegment AS groupe, r_name AS site, n_name AS zone, c_name AS localisation,
         o_orderstatus AS etat, o_orderpriority AS frequence, part_name AS nom_intervention, s_name AS prestataire,
         first_ship AS date_debut_planifiee, o_orderdate AS date_debut, last_ship AS date_cloture,
         o_totalprice AS cout, -start_hours / 24 AS days_deviation_from_plan,
         close_hours AS intervention_duration_hours, last_ship AS date_fin
  FROM placed WHERE o_orderstatus = 'F'
)"""

PARTS = """parts AS (
  SELECT l_linenumber::BIGINT AS id_demande, l_orderkey AS id_ot, l_partkey::VARCHAR AS article,
         l_partkey AS code_article, p_type AS famille, l_suppkey AS magasinier, l_quantity AS quantite_demande,
         (p_size - 1)::BIGINT AS quantite_dispo, l_extendedprice AS cout_total,
         CASE WHEN l_returnflag = 'R' THEN 'rejet' ELSE 'valide' END AS etat,
         CASE WHEN l_returnflag = 'R' THEN 'motif ' || l_linenumber::VARCHAR END AS motif_rejet,
         l_shipdate AS date_demande,
         row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

TOTALS = f"""{PARTS}, totals AS (
  SELECT id_ot, count(id_demande) AS n, sum(quantite_demande) AS qty, sum(cout_total) AS cost FROM parts GROUP BY id_ot
)"""

INTEGRATED = f"""{C}, {TOTALS}, integrated AS (
  SELECT corrective.*, coalesce(n, 0) AS num_spare_parts_requests, coalesce(qty, 0.0) AS total_parts_quantity,
         coalesce(cost, 0.0) AS total_parts_cost
  FROM corrective LEFT JOIN totals ON id_ordre_travail = id_ot
)"""

TIMES = """times AS (
  SELECT o_orderdate AS date_created, 'corrective' AS maintenance_type FROM orders WHERE o_orderstatus IN ('O', 'P')
  UNION ALL
  SELECT first_ship, 'preventive' FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'
)"""

EVENT_TIMES = """times AS (
  SELECT ts AS date_created, CASE event_type WHEN 'error' THEN 'corrective' WHEN 'view' THEN 'preventive' END
         AS maintenance_type FROM events
)"""


def r(expression: str, name: str = "", digits: int | None = None) -> str:
    """Output column on the comparison grid, optionally rounded by the report itself first."""
    value = f"CAST({expression} AS DOUBLE)"
    if digits is not None:
        value = f"round({value}, {digits})"
    digits = f"least(6, 8 - floor(log10(nullif(abs({value}), 0))))"
    step = f"pow(10::DOUBLE, coalesce({digits}, 6)::DOUBLE)"
    return f"floor({value} * {step} + 0.5003::DOUBLE) / {step} AS {name or expression}"


def rr(*names: str) -> str:
    return ", ".join(r(name) for name in names)


def med(expression: str, share: float = 0.5) -> str:
    return f"quantile_cont({expression}, {share})"


def days(start: str, end: str) -> str:
    return f"(date_diff('microsecond', {start}, {end}) / 8.64e10)"


def whole_days(start: str, end: str) -> str:
    return f"CAST(floor({days(start, end)}) AS BIGINT)"


def mode(name: str, key: str, table: str) -> str:
    return (
        f"(SELECT {key}, {name} FROM (SELECT {key}, {name}, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY count(*) DESC, {name}) AS k FROM {table} WHERE {name} IS NOT NULL GROUP BY {key}, {name}) WHERE k = 1)"
    )


Q: dict[str, str] = {}

# --- cleaning and integration ---------------------------------------------------------------------------------------

Q["clean_corrective"] = f"""WITH {ORDERS} SELECT o_orderkey AS id_ordre_travail,
  CASE WHEN o_orderstatus = 'O' THEN 'Cloture' ELSE 'Ouvert' END AS etat, o_orderdate AS date_declaration,
  o_orderdate AS date_creation_ot, CASE WHEN o_orderpriority <> '5-LOW' THEN first_ship END AS date_debut_reparation,
  last_ship AS date_cloture, returned AS est_reouvert, CASE WHEN returned THEN last_ship END AS date_reouverture,
  CASE WHEN o_orderstatus = 'O' THEN first_ship END AS date_validation, NULL::TIMESTAMP AS date_rejet,
  o_orderpriority = '1-URGENT' AS vandalisme, CASE WHEN o_orderpriority <> '5-LOW' THEN line_count > 3 END AS palliative,
  CASE WHEN line_count > 0 THEN true END AS avec_demande_pdr,
  {r("CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_totalprice ELSE 0 END", "cout_total")},
  {r("CASE WHEN line_count > 1 THEN quantity * 50 ELSE 0 END", "cout_maindoeuvre")},
  {r("CASE WHEN returned THEN quantity ELSE 0 END", "cout_pdr")}, 0.0::DOUBLE AS cout_bc,
  {r("close_hours", "time_to_closure_hours")},
  {r("CASE WHEN o_orderpriority <> '5-LOW' THEN start_hours END", "time_to_start_hours")}
  FROM placed WHERE o_orderstatus IN ('O', 'P')"""

Q["clean_preventive"] = f"""WITH {ORDERS} SELECT o_orderkey AS numero_ot, first_ship AS date_debut_planifiee,
  o_orderdate AS date_debut, last_ship AS date_fin, CASE WHEN line_count > 1 THEN last_ship END AS date_fin_planifiee,
  CASE WHEN o_orderpriority <> '5-LOW' THEN last_ship END AS date_cloture, first_ship AS date_validation,
  {r("CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_totalprice ELSE 0 END", "cout")},
  {r("-start_hours / 24", "days_deviation_from_plan")}, {r("close_hours", "intervention_duration_hours")}
  FROM placed WHERE o_orderstatus = 'F'"""

Q["clean_spare_parts"] = f"""WITH p AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END AS q
  FROM lineitem) SELECT l_orderkey AS id_ot, l_linenumber::BIGINT AS id_demande, l_partkey AS code_article,
  l_suppkey AS magasinier, l_shipdate AS date_demande,
  l_shipdate + to_hours(l_linenumber) AS date_validation_superviseur,
  CASE WHEN l_returnflag <> 'R' THEN l_shipdate + to_days(l_linenumber) END AS date_cloture,
  CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS date_rejet, {r("q", "quantite_demande")}, {r("l_extendedprice", "cout_total")},
  {r("CASE WHEN q > 0 THEN l_extendedprice / q ELSE 0 END", "cout_unitaire")},
  {r("l_linenumber", "validation_time_hours")},
  {r("CASE WHEN l_returnflag <> 'R' THEN l_linenumber * 23 END", "fulfillment_time_hours")} FROM p"""


def first_values(name: str, output: str, limit: int | None) -> str:
    keep = f"WHERE k <= {limit}" if limit else ""
    return (
        f"(SELECT id_ot, string_agg(v, ', ' ORDER BY k) AS {output} FROM (SELECT id_ot, {name} AS v, row_number() "
        f"OVER (PARTITION BY id_ot ORDER BY min(pos)) AS k FROM parts GROUP BY id_ot, {name}) {keep} GROUP BY id_ot)"
    )


Q["attach_parts"] = f"""WITH {TOTALS} SELECT o_orderkey AS id_ordre_travail, o_custkey AS id_actif,
  {r("o_totalprice", "cout_total")}, coalesce(n, 0) AS num_spare_parts_requests,
  {r("coalesce(qty, 0)", "total_parts_quantity")}, {r("coalesce(cost, 0)", "total_parts_cost")}, parts_articles,
  parts_families, s.etat AS parts_request_status
  FROM orders LEFT JOIN totals t ON o_orderkey = t.id_ot
  LEFT JOIN {first_values("article", "parts_articles", 5)} a ON o_orderkey = a.id_ot
  LEFT JOIN {first_values("famille", "parts_families", None)} f ON o_orderkey = f.id_ot
  LEFT JOIN {mode("etat", "id_ot", "parts")} s ON o_orderkey = s.id_ot
  WHERE o_orderstatus IN ('O', 'P')"""

BOTH = """both_kinds AS (
  SELECT id_actif, actif, famille, groupe, site, zone, localisation, 1 AS c, 0 AS p FROM corrective
  UNION ALL SELECT id_actif, actif, famille, groupe, site, zone, localisation, 0, 1 FROM preventive
)"""

_ATTRIBUTES = ("actif", "famille", "groupe", "site", "zone", "localisation")
Q["asset_master"] = f"""WITH {CP}, {BOTH}, n AS (SELECT id_actif, sum(c)::BIGINT AS c, sum(p)::BIGINT AS p
  FROM both_kinds GROUP BY id_actif)
  SELECT n.id_actif, {", ".join(f"m_{a}.{a}" for a in _ATTRIBUTES)},
  CASE WHEN c > 0 AND p > 0 THEN 'corrective, preventive' WHEN c > 0 THEN 'corrective' ELSE 'preventive' END AS source,
  c AS corrective_count, p AS preventive_count, c + p AS total_maintenance_count FROM n
  {" ".join(f"LEFT JOIN {mode(a, 'id_actif', 'both_kinds')} m_{a} ON n.id_actif = m_{a}.id_actif" for a in _ATTRIBUTES)}"""

Q["unified_timeline"] = f"""WITH {CP}, {TOTALS} SELECT id_ordre_travail AS order_id, date_creation_ot AS date_created,
  date_cloture, etat, anomalie AS description, urgence, site, zone, famille, actif, id_actif, {r("cout_total")},
  {r("duree_intervention_par_heure")}, prestataire, coalesce(n, 0) AS num_spare_parts_requests,
  {r("coalesce(cost, 0)", "total_parts_cost")}, 'corrective' AS maintenance_type, NULL AS frequence
  FROM corrective LEFT JOIN totals ON id_ordre_travail = id_ot
  UNION ALL SELECT numero_ot, date_debut_planifiee, date_cloture, etat, nom_intervention, NULL, site, zone, famille,
  actif, id_actif, {r("cout", "c1")}, {r("intervention_duration_hours", "c2")}, prestataire, 0, 0.0, 'preventive',
  frequence FROM preventive"""

LOCATIONS = """locations AS (
  SELECT site, zone, count(DISTINCT localisation) AS location_count, sum(c)::BIGINT AS corrective_count,
         sum(p)::BIGINT AS preventive_count, count(*) AS total_maintenance
  FROM both_kinds GROUP BY site, zone
)"""
Q["location_hierarchy"] = f"WITH {CP}, {BOTH}, {LOCATIONS} SELECT * FROM locations"

Q["relationship_summary"] = f"""WITH {CP}, {TOTALS}, {BOTH}, {LOCATIONS}, {TIMES},
  linked AS (SELECT coalesce(n, 0) AS n, coalesce(cost, 0) AS cost FROM corrective LEFT JOIN totals
    ON id_ordre_travail = id_ot),
  a AS (SELECT sum(c) AS c, sum(p) AS p FROM both_kinds GROUP BY id_actif),
  s AS (SELECT site, sum(total_maintenance)::BIGINT AS e FROM locations GROUP BY site ORDER BY e DESC, site LIMIT 1)
  SELECT (SELECT count(*) FROM linked WHERE n > 0) AS orders_with_parts,
  {r("(SELECT avg(CASE WHEN n > 0 THEN 100.0 ELSE 0 END) FROM linked)", "orders_with_parts_pct")},
  {r("(SELECT avg(n) FROM linked WHERE n > 0)", "avg_parts_per_order")},
  {r("(SELECT avg(cost) FROM linked WHERE n > 0)", "avg_parts_cost_per_order")},
  (SELECT count(*) FROM a) AS total_assets, (SELECT count(*) FROM a WHERE p = 0) AS assets_corrective_only,
  (SELECT count(*) FROM a WHERE c = 0) AS assets_preventive_only,
  (SELECT count(*) FROM a WHERE c > 0 AND p > 0) AS assets_both,
  {r("(SELECT avg(c + p) FROM a)", "avg_maintenance_per_asset")},
  (SELECT count(DISTINCT site) FROM locations) AS total_sites, (SELECT count(*) FROM locations) AS total_zones,
  s.site AS most_active_site, s.e AS most_active_site_count, (SELECT count(*) FROM times) AS total_events,
  (SELECT count(*) FROM times WHERE maintenance_type = 'corrective') AS corrective_events,
  (SELECT count(*) FROM times WHERE maintenance_type = 'preventive') AS preventive_events,
  (SELECT {whole_days("min(date_created)", "max(date_created)")} FROM times) AS date_range_days FROM s"""

_PLACE = "id_actif bigint, actif string, famille string, groupe string, site string, zone string, localisation string"
_QUALITY = {
    "corrective": f"""id_ordre_travail bigint, {_PLACE}, portfolio string, etat string, urgence string, anomalie string,
        prestataire string, date_declaration timestamp, date_creation_ot timestamp, date_debut_reparation timestamp,
        date_cloture timestamp, cout_total double, cout_maindoeuvre double, nombre_main_doeuvre bigint,
        duree_intervention_par_heure double, est_reouvert boolean, time_to_closure_hours double, time_to_start_hours double""",
    "preventive": f"""numero_ot bigint, {_PLACE}, etat string, frequence string, nom_intervention string, prestataire string,
        date_debut_planifiee timestamp, date_debut timestamp, date_fin timestamp, date_cloture timestamp, cout double,
        days_deviation_from_plan double, intervention_duration_hours double""",
    "parts": """id_demande bigint, id_ot bigint, article string, code_article bigint, famille string, magasinier bigint,
        quantite_demande double, quantite_dispo bigint, cout_total double, etat string, motif_rejet string,
        date_demande timestamp""",
}


def quality_rows(table: str, columns: list[list[str]]) -> str:
    names = ", ".join(name for name, _ in columns)
    again = f"(SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM {table} GROUP BY {names}))"
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, count(*) AS total_rows,
  count(*) FILTER (WHERE {name} IS NULL) AS missing_count,
  {r(f"avg(CASE WHEN {name} IS NULL THEN 100.0 ELSE 0 END)", "missing_pct")},
  {len(columns)}::BIGINT AS total_columns, {again} AS duplicates FROM {table}"""
        for name, kind in columns
    )


Q["data_quality_report"] = f"WITH {CP}, {PARTS} " + " UNION ALL ".join(
    quality_rows(table, [c.split() for c in columns.split(",")]) for table, columns in _QUALITY.items()
)

Q["duplicate_part_lines"] = f"""WITH {PARTS} SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicates
  FROM (SELECT count(*) AS n FROM parts GROUP BY id_demande, id_ot, article, code_article, famille, magasinier,
  quantite_demande, quantite_dispo, cout_total, etat, motif_rejet, date_demande)"""

# --- features -------------------------------------------------------------------------------------------------------

GAPS = """gaps AS (
  SELECT *, date_diff('microsecond', lag(date_creation_ot) OVER w, date_creation_ot) / 8.64e10 AS gap,
         lead(date_creation_ot) OVER w AS next_failure_date
  FROM corrective WINDOW w AS (PARTITION BY id_actif ORDER BY date_creation_ot, id_ordre_travail)
)"""
GAP = f"coalesce(gap, (SELECT {med('gap')} FROM gaps))"
CALENDAR = """hour(date_creation_ot) AS creation_hour, isodow(date_creation_ot) - 1 AS creation_day_of_week,
  day(date_creation_ot) AS creation_day_of_month, month(date_creation_ot) AS creation_month,
  quarter(date_creation_ot) AS creation_quarter,
  CASE WHEN isodow(date_creation_ot) >= 6 THEN 1 ELSE 0 END AS creation_is_weekend,
  CASE WHEN hour(date_creation_ot) BETWEEN 8 AND 17 THEN 1 ELSE 0 END AS creation_is_business_hours"""
Q["time_features"] = f"""WITH {C}, {GAPS} SELECT id_ordre_travail, id_actif, date_creation_ot, {CALENDAR},
  {r(GAP, "days_since_last_maintenance")} FROM gaps"""

ASSET_COLUMNS = f"""count(*) OVER a AS equipment_failure_count, {r("avg(cout_total) OVER a", "equipment_avg_cost")},
  {r("avg(duree_intervention_par_heure) OVER a", "equipment_avg_duration")}"""
AGE = f"""{r(days("min(date_creation_ot) OVER a", "date_creation_ot"), "equipment_age_days")}"""
FAMILY_COLUMNS = f"""count(*) OVER f AS famille_failure_count, {r("avg(cout_total) OVER f", "famille_avg_cost")}"""
WINDOWS = """WINDOW a AS (PARTITION BY id_actif), f AS (PARTITION BY famille), s AS (PARTITION BY site),
  z AS (PARTITION BY site, zone), p AS (PARTITION BY prestataire),
  w7 AS (PARTITION BY id_actif ORDER BY date_creation_ot, id_ordre_travail ROWS 6 PRECEDING),
  w30 AS (PARTITION BY id_actif ORDER BY date_creation_ot, id_ordre_travail ROWS 29 PRECEDING)"""
Q["equipment_features"] = f"""WITH {C} SELECT id_ordre_travail, id_actif, date_creation_ot, famille, {ASSET_COLUMNS},
  min(date_creation_ot) OVER a AS first_maintenance_date, {AGE}, {FAMILY_COLUMNS} FROM corrective {WINDOWS}"""

SITE_COLUMNS = f"""count(*) OVER s AS site_failure_count, {r("avg(cout_total) OVER s", "site_avg_cost")},
  count(*) OVER z AS zone_failure_count"""
Q["location_features"] = f"""WITH {C} SELECT id_ordre_travail, site, zone, {r("cout_total")}, {SITE_COLUMNS}
  FROM corrective {WINDOWS}"""

HAS_PARTS = "CASE WHEN num_spare_parts_requests > 0 THEN 1 ELSE 0 END"
PART_COLUMNS = f"""{HAS_PARTS} AS has_spare_parts,
  {r("CASE WHEN cout_total > 0 THEN total_parts_cost / cout_total ELSE 0 END", "spare_parts_cost_ratio")},
  {r(f"avg({HAS_PARTS}) OVER f", "famille_spare_parts_usage_rate")}"""
Q["spare_parts_features"] = f"""WITH {INTEGRATED} SELECT id_ordre_travail, famille, {r("cout_total")},
  num_spare_parts_requests, {rr("total_parts_quantity", "total_parts_cost")}, {PART_COLUMNS} FROM integrated {WINDOWS}"""

TOP20 = """top20 AS (SELECT anomalie FROM corrective WHERE anomalie IS NOT NULL GROUP BY anomalie
  ORDER BY count(*) DESC, anomalie LIMIT 20)"""
RECUR = """recur AS (SELECT id_actif AS ra, max(n) AS anomaly_recurrence_count FROM (SELECT id_actif, anomalie, count(*)
  AS n FROM corrective WHERE anomalie IS NOT NULL GROUP BY id_actif, anomalie) GROUP BY id_actif)"""
FLAGS = "CASE WHEN anomalie IN (SELECT anomalie FROM top20) THEN 1 ELSE 0 END AS flags_set"
Q["anomaly_features"] = f"""WITH {C}, {TOP20}, {RECUR} SELECT id_ordre_travail, anomalie, {FLAGS},
  anomaly_recurrence_count FROM corrective LEFT JOIN recur ON id_actif = ra"""

URGENT = r("avg(CASE WHEN urgence = 'Fort' THEN 1 ELSE 0 END) OVER f", "famille_high_urgency_rate")
LEVELS = """urgence = 'Faible' AS "urgence_Faible", urgence = 'Fort' AS "urgence_Fort", urgence = 'Moyen'
  AS "urgence_Moyen\""""
Q["urgency_features"] = f"""WITH {C} SELECT id_ordre_travail, famille, urgence, {LEVELS}, {URGENT}
  FROM corrective {WINDOWS}"""


def keyed(expression: str) -> str:
    return f"CASE WHEN prestataire IS NOT NULL THEN {expression} END"


PROVIDER_COLUMNS = f"""{r(keyed("avg(time_to_closure_hours) OVER p"), "provider_avg_time_to_closure")},
  {r(keyed("avg(cout_total) OVER p"), "provider_avg_cost")}, {keyed("count(*) OVER p")} AS provider_work_volume"""
Q["provider_features"] = f"""WITH {C} SELECT id_ordre_travail, prestataire, {rr("cout_total", "time_to_closure_hours")},
  {PROVIDER_COLUMNS} FROM corrective {WINDOWS}"""

ROLLING = f"""count(id_ordre_travail) OVER w7 AS rolling_7d_failures, count(id_ordre_travail) OVER w30
  AS rolling_30d_failures, {r("avg(cout_total) OVER w7", "rolling_7d_avg_cost")},
  {r("avg(cout_total) OVER w30", "rolling_30d_avg_cost")}"""
Q["rolling_features"] = f"""WITH {C} SELECT id_ordre_travail, id_actif, date_creation_ot, {r("cout_total")}, {ROLLING}
  FROM corrective {WINDOWS}"""

Q["rolling_features_time"] = f"""WITH {C} SELECT id_ordre_travail, id_actif, date_creation_ot,
  count(*) OVER d7 AS last_7_days_failures, {r("avg(cout_total) OVER d7", "last_7_days_avg_cost")},
  count(*) OVER d30 AS last_30_days_failures, {r("avg(cout_total) OVER d30", "last_30_days_avg_cost")} FROM corrective
  WINDOW d7 AS (PARTITION BY id_actif ORDER BY date_creation_ot RANGE INTERVAL 7 DAY PRECEDING),
  d30 AS (PARTITION BY id_actif ORDER BY date_creation_ot RANGE INTERVAL 30 DAY PRECEDING)"""

_ENCODED = ("portfolio", "site", "zone", "famille", "groupe", "prestataire", "etat")


def code(name: str) -> str:
    return f"dense_rank() OVER (ORDER BY coalesce({name}, 'nan')) - 1"


ENCODED = ", ".join(f"{code(n)} AS {n}_encoded" for n in _ENCODED)
Q["encode_categoricals"] = f"WITH {C} SELECT id_ordre_travail, {', '.join(_ENCODED)}, {ENCODED} FROM corrective"

NEXT = days("date_creation_ot", "next_failure_date")
SOON = f"CASE WHEN {NEXT} <= 30 THEN 1 ELSE 0 END"
TARGETS = f"""{r(NEXT, "days_to_next_failure")}, {SOON} AS will_fail_within_30_days,
  {code("anomalie")} AS anomaly_type_encoded, {r("coalesce(cost, 0)", "spare_parts_cost_target")},
  {r("duree_intervention_par_heure", "intervention_duration_target")},
  CASE WHEN coalesce(n, 0) > 0 THEN 1 ELSE 0 END AS will_need_spare_parts"""
Q["create_targets"] = f"""WITH {C}, {GAPS}, {TOTALS} SELECT id_ordre_travail, id_actif, date_creation_ot, anomalie,
  {r("duree_intervention_par_heure")}, coalesce(n, 0) AS num_spare_parts_requests,
  {r("coalesce(qty, 0)", "total_parts_quantity")}, {r("coalesce(cost, 0)", "total_parts_cost")},
  CASE WHEN coalesce(n, 0) > 0 THEN 1 ELSE 0 END AS has_spare_parts, next_failure_date, {TARGETS}
  FROM gaps LEFT JOIN totals ON id_ordre_travail = id_ot"""

Q["feature_table"] = f"""WITH {C}, {GAPS}, {TOTALS}, {TOP20}, {RECUR}, integrated AS (
    SELECT gaps.*, coalesce(n, 0) AS num_spare_parts_requests, coalesce(qty, 0) AS total_parts_quantity,
    coalesce(cost, 0) AS total_parts_cost, n, cost FROM gaps LEFT JOIN totals ON id_ordre_travail = id_ot)
  SELECT id_ordre_travail, id_actif, famille, groupe, site, zone, portfolio, etat, urgence, prestataire,
  {rr("cout_total", "cout_maindoeuvre", "duree_intervention_par_heure", "time_to_closure_hours", "time_to_start_hours")},
  nombre_main_doeuvre, num_spare_parts_requests, {rr("total_parts_quantity", "total_parts_cost")}, {CALENDAR},
  {r(GAP, "days_since_last_maintenance")}, {ASSET_COLUMNS}, {AGE}, {FAMILY_COLUMNS}, {SITE_COLUMNS}, {PART_COLUMNS},
  {FLAGS}, anomaly_recurrence_count, {LEVELS}, {URGENT}, {PROVIDER_COLUMNS}, {ROLLING}, {ENCODED}, {TARGETS}
  FROM integrated LEFT JOIN recur ON id_actif = ra {WINDOWS}"""

Q["anomaly_flag_rows"] = f"""WITH {C}, {TOP20} SELECT id_ordre_travail,
  substr('anomaly_' || lower(replace(anomalie, ' ', '_')), 1, 50) AS flag, 1 AS value
  FROM corrective WHERE anomalie IN (SELECT anomalie FROM top20)"""
Q["urgency_flag_rows"] = f"WITH {C} SELECT id_ordre_travail, 'urgence_' || urgence AS flag, 1 AS value FROM corrective"
_NUMBERS = (
    "cout_total cout_maindoeuvre duree_intervention_par_heure time_to_closure_hours time_to_start_hours nombre_main_doeuvre "
    "num_spare_parts_requests total_parts_quantity total_parts_cost creation_hour creation_day_of_week creation_day_of_month "
    "creation_month creation_quarter creation_is_weekend creation_is_business_hours days_since_last_maintenance "
    "equipment_failure_count equipment_avg_cost equipment_avg_duration equipment_age_days famille_failure_count famille_avg_cost "
    "site_failure_count site_avg_cost zone_failure_count has_spare_parts spare_parts_cost_ratio famille_spare_parts_usage_rate "
    "anomaly_recurrence_count famille_high_urgency_rate provider_avg_time_to_closure provider_avg_cost provider_work_volume "
    "rolling_7d_failures rolling_30d_failures rolling_7d_avg_cost rolling_30d_avg_cost portfolio_encoded site_encoded zone_encoded "
    "famille_encoded groupe_encoded prestataire_encoded etat_encoded"
).split()
Q["feature_correlations"] = f"""WITH f AS ({Q["feature_table"]}), m AS (SELECT unnest([{", ".join(
    f"{{'feature_a': '{a}', 'feature_b': '{b}', 'correlation': corr({a}, {b})}}" for a in _NUMBERS for b in _NUMBERS)}]) AS p FROM f)
  SELECT p.feature_a, p.feature_b, {r("CASE WHEN isfinite(p.correlation) THEN p.correlation END", "correlation")} FROM m"""

# --- effectiveness ----------------------------------------------------------------------------------------------------

_METRICS = ("total_interventions", "avg_duration_hours", "median_duration_hours", "avg_cost", "total_cost", "unique_equipment")


def compared(names, third: str, third_name: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS metric, {r(f"c.{n}", "corrective")}, {r(f"p.{n}", "preventive")},
  {r(third.format(n=n), third_name)} FROM c, p"""
        for n in names
    )


COMPARE = f"""c AS (SELECT count(*) AS total_interventions, avg(duree_intervention_par_heure) AS avg_duration_hours,
  {med("duree_intervention_par_heure")} AS median_duration_hours, avg(cout_total) AS avg_cost,
  sum(cout_total) AS total_cost, count(DISTINCT id_actif) AS unique_equipment FROM corrective),
  p AS (SELECT count(*) AS total_interventions, avg(intervention_duration_hours) AS avg_duration_hours,
  {med("intervention_duration_hours")} AS median_duration_hours, avg(cout) AS avg_cost, sum(cout) AS total_cost,
  count(DISTINCT id_actif) AS unique_equipment FROM preventive)"""
RATIO = "c.{n} / nullif(CAST(p.{n} AS DOUBLE), 0)"
Q["compare_maintenance_types"] = f"WITH {CP}, {COMPARE} {compared(_METRICS, RATIO, 'ratio')}"

COSTED = f"""{CP}, {TOTALS}, made AS (
    SELECT *, time_to_closure_hours AS duration_hours, coalesce(cost, 0) AS parts_cost,
           time_to_closure_hours * 50 + coalesce(cost, 0) AS total_cost
    FROM corrective LEFT JOIN totals ON id_ordre_travail = id_ot WHERE time_to_closure_hours > 0),
  plan AS (SELECT *, intervention_duration_hours AS duration_hours, intervention_duration_hours * 50 AS total_cost
    FROM preventive WHERE intervention_duration_hours > 0)"""
_LABOUR = ("total_interventions", "avg_duration_hours", "avg_cost", "total_cost", "avg_parts_cost", "interventions_per_equipment")


def labour(table: str, parts: str) -> str:
    return f"""(SELECT count(*) AS total_interventions, avg(duration_hours) AS avg_duration_hours,
  avg(total_cost) AS avg_cost, sum(total_cost) AS total_cost, {parts} AS avg_parts_cost,
  count(*) / count(DISTINCT id_actif)::DOUBLE AS interventions_per_equipment FROM {table})"""


DIFF = "(c.{n} - p.{n}) / nullif(CAST(p.{n} AS DOUBLE), 0) * 100"
Q["compare_labour_costs"] = f"""WITH {COSTED}, c AS {labour("made", "avg(parts_cost)")}, p AS {labour("plan", "0.0")}
  {compared(_LABOUR, DIFF, "difference_pct")}"""

FAM = """fam AS (
  SELECT *, corr_avg_cost / nullif(prev_avg_cost, 0) AS cost_ratio, corr_count / nullif(prev_count::DOUBLE, 0)
         AS intervention_ratio,
         200 / (1 + coalesce(corr_avg_cost / nullif(prev_avg_cost, 0), 1)
                + coalesce(corr_count / nullif(prev_count::DOUBLE, 0), 1)) AS effectiveness_score
  FROM (SELECT famille, count(*) AS corr_count, avg(cout_total) AS corr_avg_cost, sum(cout_total) AS corr_total_cost
        FROM corrective GROUP BY famille)
  JOIN (SELECT famille, count(*) AS prev_count, avg(cout) AS prev_avg_cost, sum(cout) AS prev_total_cost
        FROM preventive GROUP BY famille) USING (famille)
)"""
Q["effectiveness_by_family"] = f"""WITH {CP}, {FAM} SELECT famille, corr_count, prev_count, {rr("corr_avg_cost",
  "corr_total_cost", "prev_avg_cost", "prev_total_cost", "cost_ratio", "intervention_ratio", "effectiveness_score")}
  FROM fam"""
Q["best_and_worst_families"] = f"""WITH {CP}, {FAM}
  (SELECT famille, {rr("effectiveness_score")}, 'top' AS side FROM fam ORDER BY fam.effectiveness_score DESC, famille LIMIT 3)
  UNION ALL (SELECT famille, {rr("effectiveness_score")}, 'bottom' FROM fam ORDER BY fam.effectiveness_score, famille LIMIT 3)"""

ROI = """roi AS (
  SELECT *, avoided - invested AS net, CASE WHEN invested > 0 THEN (avoided - invested) / invested * 100 ELSE 0 END AS pct
  FROM (SELECT (SELECT sum(cout) FROM preventive) AS invested,
    (SELECT avg(x) FROM (SELECT sum(cout_total) AS x FROM corrective GROUP BY id_actif))
    * (SELECT count(DISTINCT id_actif) FROM preventive) * 0.6 AS avoided)
)"""
ROI_COLUMNS = f"""{r("invested", "preventive_investment")}, {r("avoided", "estimated_cost_avoided")},
  {r("net", "net_benefit")}, {r("pct", "roi_percent")}"""
Q["calculate_roi"] = f"WITH {CP}, {ROI} SELECT {ROI_COLUMNS} FROM roi"
Q["roi_by_family"] = f"""WITH {CP}, {FAM} SELECT famille, {r("prev_total_cost", "preventive_cost")},
  {r("corr_total_cost", "corrective_cost")}, {r("corr_total_cost * 0.6", "estimated_avoided")},
  {r("CASE WHEN prev_total_cost > 0 THEN (corr_total_cost * 0.6 - prev_total_cost) / prev_total_cost * 100 ELSE 0 END",
     "roi_percent")} FROM fam"""

NEXT_CORRECTIVE = """followed AS (
  SELECT p.id_actif, p.numero_ot, p.date_debut AS preventive_date, c.t AS next_corrective_date
  FROM preventive p ASOF LEFT JOIN (SELECT DISTINCT id_actif, date_creation_ot AS t FROM corrective) c
  ON p.id_actif = c.id_actif AND p.date_debut < c.t
)"""
INTERVALS = f"""{NEXT_CORRECTIVE}, spans AS (
  SELECT *, {whole_days("preventive_date", "next_corrective_date")} AS days_until_failure FROM followed
  WHERE next_corrective_date IS NOT NULL
)"""
Q["maintenance_intervals"] = f"WITH {CP}, {INTERVALS} SELECT * FROM spans"
Q["recommended_interval"] = f"""WITH {CP}, {INTERVALS} SELECT {r(med("days_until_failure", 0.75), "optimal_interval_days")},
  count(*) AS intervals FROM spans"""
SIGNALS = """corrective AS (SELECT user_id AS id_actif, ts AS date_creation_ot FROM events WHERE event_type = 'error'),
  preventive AS (SELECT event_id AS numero_ot, user_id AS id_actif, ts AS date_debut FROM events
    WHERE event_type = 'view')"""
Q["signal_intervals"] = f"WITH {SIGNALS}, {INTERVALS} SELECT * FROM spans"

COMPLY = f"""comply AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE abs(d) <= 1) AS on_time, avg(d) AS mean, {med("d")} AS mid
  FROM (SELECT days_deviation_from_plan AS d FROM preventive WHERE days_deviation_from_plan IS NOT NULL)
)"""
COMPLY_COLUMNS = f"""{r("on_time * 100.0 / total", "compliance_rate")}, {r("mean", "avg_deviation_days")},
  {r("mid", "median_deviation_days")}, on_time AS on_time_count, total AS total_with_data"""
Q["preventive_compliance"] = f"WITH {CP}, {COMPLY} SELECT {COMPLY_COLUMNS} FROM comply"
Q["compliance_by_site"] = f"""WITH {CP} SELECT site, count(*) AS total,
  count(*) FILTER (WHERE abs(days_deviation_from_plan) <= 1) AS on_time,
  {r("count(*) FILTER (WHERE abs(days_deviation_from_plan) <= 1) * 100.0 / count(*)", "rate", 1)}
  FROM preventive WHERE days_deviation_from_plan IS NOT NULL GROUP BY site"""
Q["deviation_by_frequency"] = f"""WITH {CP} SELECT frequence, {r("avg(days_deviation_from_plan)", "mean")},
  {r(med("days_deviation_from_plan"), "median")}, count(days_deviation_from_plan) AS count FROM preventive
  GROUP BY frequence"""
Q["preventive_status_distribution"] = """SELECT o_orderstatus AS etat, count(*) AS count FROM orders
  WHERE o_orderstatus = 'F' GROUP BY o_orderstatus"""

Q["preventive_frequency_distribution"] = """SELECT o_orderpriority AS frequence, count(*) AS count FROM orders
  WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"""

LABELS = f"""{NEXT_CORRECTIVE}, labels AS (
  SELECT f.id_actif, f.numero_ot, first_value(p.famille) OVER (PARTITION BY f.id_actif ORDER BY f.preventive_date,
         f.numero_ot) AS famille, p.intervention_duration_hours AS prev_duration, p.cout AS prev_cost,
         coalesce(floor({days("f.preventive_date", "f.next_corrective_date")}) > 90, true) AS is_effective
  FROM followed f JOIN preventive p USING (numero_ot) WHERE f.id_actif IN (SELECT id_actif FROM corrective)
)"""
Q["effectiveness_labels"] = f"""WITH {CP}, {LABELS} SELECT id_actif, numero_ot, famille, {rr("prev_duration", "prev_cost")},
  is_effective FROM labels"""
Q["effective_share"] = f"""WITH {CP}, {LABELS} SELECT count(*) AS planned_orders,
  {r("avg(is_effective::INT)", "effective_share")} FROM labels"""


def monthly(table: str, time: str, kind: str) -> str:
    return f"""SELECT strftime({time}, '%Y-%m') AS year_month, count(*) AS n_interventions, {r("sum(total_cost)", "total_cost")},
  {r("avg(duration_hours)", "avg_duration")}, '{kind}' AS maintenance_type FROM {table} GROUP BY ALL"""


Q["monthly_trend"] = f"""WITH {COSTED} {monthly("made", "date_creation_ot", "Corrective")} UNION ALL
  {monthly("plan", "date_debut", "Preventive")}"""

Q["recommendations"] = f"""WITH {COSTED}, {ROI}, {FAM}, {INTERVALS}, advice AS (
  SELECT 1 AS k, CASE WHEN pct > 0 THEN 'Continue and expand preventive maintenance programs (positive ROI)'
    ELSE 'Optimize preventive maintenance schedules to improve ROI' END AS recommendation FROM roi
  UNION ALL SELECT 2, 'Implement preventive maintenance every ' || CAST(round_even({med("days_until_failure", 0.75)}, 0)
    AS BIGINT)::VARCHAR || ' days' FROM spans HAVING count(*) > 0
  UNION ALL SELECT 3, 'Focus improvement efforts on ' || count(*)::VARCHAR || ' low-performing equipment families'
    FROM fam WHERE effectiveness_score < 30 HAVING count(*) > 0
  UNION ALL SELECT 4, 'Increase preventive maintenance frequency to reduce high corrective costs'
    WHERE (SELECT avg(total_cost) FROM made) > 2 * (SELECT avg(total_cost) FROM plan))
  SELECT row_number() OVER (ORDER BY k) AS rank, recommendation FROM advice"""

_FLAT = ", ".join(
    f"""{r(f"c.{n}", f"corrective_{n}")}, {r(f"p.{n}", f"preventive_{n}")}, {r(RATIO.format(n=n), f"ratio_{n}")}"""
    for n in _METRICS
)
Q["effectiveness_summary"] = f"""WITH {CP}, {COMPARE}, {ROI}, {COMPLY}, {FAM}, {INTERVALS} SELECT {ROI_COLUMNS},
  {COMPLY_COLUMNS}, (SELECT {med("days_until_failure::DOUBLE", 0.75)} FROM spans) AS optimal_interval_days,
  (SELECT count(*) FROM fam) AS n_families_analyzed, {_FLAT} FROM c, p, roi, comply"""

# --- spare parts ----------------------------------------------------------------------------------------------------------

PARETO = """pareto AS (
  SELECT *, sum(total_cost) OVER (ORDER BY total_cost DESC, article ROWS UNBOUNDED PRECEDING) AS cumulative_cost,
         sum(total_cost) OVER (ORDER BY total_cost DESC, article ROWS UNBOUNDED PRECEDING) / sum(total_cost) OVER () * 100
         AS cumulative_pct
  FROM (SELECT article, sum(cout_total) AS total_cost, sum(quantite_demande) AS total_quantity,
        count(id_demande) AS request_count FROM parts GROUP BY article)
)"""
_PARETO = f"article, request_count, {rr('total_cost', 'total_quantity', 'cumulative_cost', 'cumulative_pct')}"
Q["pareto_analysis"] = f"WITH {PARTS}, {PARETO} SELECT {_PARETO} FROM pareto"
Q["pareto_set"] = f"WITH {PARTS}, {PARETO} SELECT {_PARETO} FROM pareto WHERE pareto.cumulative_pct <= 80"
Q["consumption_by_family"] = f"""WITH {PARTS} SELECT famille, {r("sum(cout_total)", "total_cost")},
  {r("avg(cout_total)", "avg_cost")}, count(cout_total) AS cost_count, {r("sum(quantite_demande)", "total_quantity")}
  FROM parts GROUP BY famille"""
SPAN = f"(SELECT greatest({whole_days('min(date_demande)', 'max(date_demande)')}, 1) FROM parts)"
FORECAST = f"""forecast AS (
  SELECT article, sum(quantite_demande) AS total_qty, sum(cout_total) AS total_cost, count(id_demande) AS n_requests,
         arg_min(famille, pos) AS famille, sum(quantite_demande) / {SPAN} AS daily_demand,
         sum(quantite_demande) / {SPAN} * 90 AS forecast_qty,
         coalesce(sum(cout_total) / nullif(sum(quantite_demande), 0) * (sum(quantite_demande) / {SPAN} * 90), 0)
         AS forecast_cost
  FROM parts GROUP BY article
)"""
Q["demand_forecast"] = f"""WITH {PARTS}, {FORECAST} SELECT article, famille, n_requests, {rr("total_qty", "total_cost",
  "daily_demand", "forecast_qty", "forecast_cost")} FROM forecast"""
REORDER = f"""reorder AS (
  SELECT *, current_stock < reorder_point AS needs_reorder,
         round_even(greatest(reorder_point * 2 - current_stock, 0), 0) AS suggested_order_qty
  FROM (SELECT *, daily_demand * 7 + 1.5 * demand_std AS reorder_point
        FROM (SELECT article, sum(quantite_demande) AS total_demand, avg(quantite_demande) AS avg_demand_per_request,
              coalesce(stddev_samp(quantite_demande), 0) AS demand_std, arg_max(quantite_dispo, pos) AS current_stock,
              arg_min(famille, pos) AS famille, sum(cout_total) AS total_cost,
              sum(quantite_demande) / {SPAN} AS daily_demand FROM parts GROUP BY article))
)"""
Q["reorder_analysis"] = f"""WITH {PARTS}, {REORDER} SELECT article, famille, current_stock, needs_reorder,
  {rr("total_demand", "avg_demand_per_request", "demand_std", "total_cost", "daily_demand", "reorder_point",
      "suggested_order_qty")} FROM reorder"""
Q["stock_out_cost_by_family"] = f"""WITH {PARTS} SELECT famille, {r("sum(cout_total)", "stockout_cost")},
  count(cout_total) AS requests FROM parts WHERE quantite_dispo = 0 GROUP BY famille"""
Q["stock_out_overview"] = f"""WITH {PARTS} SELECT count(*) FILTER (WHERE quantite_dispo = 0) AS stockout_requests,
  {r("count(*) FILTER (WHERE quantite_dispo = 0) * 100.0 / count(*)", "stockout_pct")},
  {r("coalesce(sum(cout_total) FILTER (WHERE quantite_dispo = 0), 0)", "stockout_cost")} FROM parts"""
HEALTH = f"""count(*) AS total_requests, count(DISTINCT article) AS unique_articles,
  count(*) FILTER (WHERE quantite_dispo < quantite_demande) AS stock_out_count,
  {r("count(*) FILTER (WHERE quantite_dispo < quantite_demande) * 100.0 / count(*)", "stock_out_pct", 1)},
  count(*) FILTER (WHERE etat = 'rejet') AS rejection_count,
  {r("count(*) FILTER (WHERE etat = 'rejet') * 100.0 / count(*)", "rejection_rate_pct", 1)},
  {r("sum(cout_total)", "total_cost")}"""
Q["stock_health_summary"] = f"WITH {PARTS} SELECT {HEALTH} FROM parts"
Q["top_stock_out_families"] = f"""WITH {PARTS} SELECT famille, count(*) AS count FROM parts
  WHERE quantite_dispo < quantite_demande GROUP BY famille ORDER BY count(*) DESC, famille LIMIT 5"""
Q["stock_by_family"] = f"WITH {PARTS} SELECT famille, {r('avg(quantite_dispo)', 'avg_stock')} FROM parts GROUP BY famille"
Q["rejection_reasons"] = f"""WITH {PARTS} SELECT motif_rejet, count(*) AS count FROM parts WHERE etat = 'rejet'
  GROUP BY motif_rejet ORDER BY count(*) DESC, motif_rejet LIMIT 10"""
Q["rejections_by_family"] = f"""WITH {PARTS} SELECT famille, count(*) AS count FROM parts WHERE etat = 'rejet'
  GROUP BY famille"""
Q["spare_parts_summary"] = f"""WITH {PARTS}, {PARETO}, {FORECAST}, {REORDER} SELECT {HEALTH},
  (SELECT count(*) FROM pareto WHERE cumulative_pct <= 80) AS pareto_80_count,
  (SELECT count(*) FROM pareto) AS pareto_total_articles,
  (SELECT count(*) FROM reorder WHERE needs_reorder) AS articles_needing_reorder,
  {r("(SELECT sum(forecast_cost) FROM forecast)", "total_forecast_cost_90d")} FROM parts"""

# --- exploration ------------------------------------------------------------------------------------------------------------

Q["daily_volume"] = f"""WITH {LINES}, {TIMES} SELECT CAST(date_created AS DATE) AS date, maintenance_type, count(*) AS count
  FROM times WHERE date_created IS NOT NULL GROUP BY ALL"""


def described(expression: str) -> str:
    return f"""count({expression}) AS count, {r(f"avg({expression})", "mean")}, {r(f"stddev_samp({expression})", "std")},
  {r(f"min({expression})", "min")}, {r(med(expression, 0.25), "p25")}, {r(med(expression), "p50")},
  {r(med(expression, 0.75), "p75")}, {r(f"max({expression})", "max")}"""


Q["daily_volume_profile"] = f"""WITH {LINES}, {TIMES}, d AS (SELECT CAST(date_created AS DATE) AS day,
  count(*) FILTER (WHERE maintenance_type = 'corrective') AS c, count(*) FILTER (WHERE maintenance_type = 'preventive') AS p
  FROM times WHERE date_created IS NOT NULL GROUP BY ALL)
  SELECT 'corrective' AS maintenance_type, {described("c")} FROM d
  UNION ALL SELECT 'preventive', {described("p")} FROM d"""
_DAYS = "['Lun', 'Mar', 'Mer', 'Jeu', 'Ven', 'Sam', 'Dim'][isodow(date_created)]"
Q["weekday_volume"] = f"""WITH {LINES}, {TIMES} SELECT isodow(date_created) - 1 AS day_of_week, maintenance_type,
  count(*) AS count, {_DAYS} AS jour FROM times WHERE date_created IS NOT NULL GROUP BY ALL"""
Q["hourly_volume"] = f"""WITH {EVENT_TIMES} SELECT hour(date_created) AS hour, maintenance_type, count(*) AS count
  FROM times WHERE maintenance_type IS NOT NULL GROUP BY ALL"""
Q["busiest_times"] = f"""WITH {EVENT_TIMES} SELECT
  (SELECT {_DAYS} AS d FROM times GROUP BY d, isodow(date_created) ORDER BY count(*) DESC, isodow(date_created) LIMIT 1)
  AS busiest_day,
  (SELECT hour(date_created) AS h FROM times GROUP BY h ORDER BY count(*) DESC, h LIMIT 1) AS busiest_hour"""
Q["overview"] = """SELECT (SELECT count(*) FROM orders) AS total_events,
  (SELECT count(*) FROM orders WHERE o_orderstatus IN ('O', 'P')) AS corrective_orders,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS preventive_orders,
  (SELECT count(DISTINCT o_custkey) FROM orders) AS assets"""


def counted(name: str, limit: int | None) -> str:
    cut = f"ORDER BY count(*) DESC, {name} LIMIT {limit}" if limit else ""
    return f"SELECT {name}, count(*) AS count FROM corrective WHERE {name} IS NOT NULL GROUP BY {name} {cut}"


def shared(name: str) -> str:
    return f"""SELECT {name}, count(*) AS count, {r("count(*) * 100.0 / sum(count(*)) OVER ()", "share_pct")}
  FROM corrective GROUP BY {name}"""


Q["top_anomaly_types"] = f"WITH {C} {counted('anomalie', 15)}"
Q["top_families"] = f"WITH {C} {counted('famille', 10)}"
Q["status_distribution"] = f"WITH {C} {shared('etat')}"
Q["urgency_distribution"] = f"WITH {C} {shared('urgence')}"
Q["mtbf_by_family"] = f"""WITH {C}, {GAPS} SELECT famille, {r("avg(gap)", "mtbf_days")}, {r(med("gap"), "median_days")},
  count(gap) AS observations FROM gaps GROUP BY famille HAVING count(gap) >= 5 ORDER BY avg(gap), famille LIMIT 15"""
_HOT = f"""count(*) AS failure_count, {r("sum(cout_total)", "total_cost")},
  count(*) FILTER (WHERE urgence = 'Fort') AS high_urgency_count"""
Q["failures_by_site"] = f"WITH {C} SELECT site, {_HOT} FROM corrective GROUP BY site"
Q["failures_by_zone"] = f"WITH {C} SELECT site, zone, {_HOT} FROM corrective GROUP BY site, zone"
Q["recurrence_summary"] = f"""WITH {C}, a AS (SELECT count(*) AS n, sum(cout_total) AS cost FROM corrective GROUP BY id_actif)
  SELECT (SELECT count(*) FROM a WHERE n > 1) AS recurring_assets,
  {r("(SELECT avg(n) FROM a WHERE n > 1)", "avg_failures_per_recurring")},
  (SELECT count(*) FROM a WHERE n >= 3) AS assets_3plus, {r("(SELECT sum(cost) FROM a WHERE n >= 3)", "cost_3plus")},
  count(*) FILTER (WHERE est_reouvert) AS reopened_orders,
  {r("count(*) FILTER (WHERE est_reouvert) * 100.0 / count(*)", "reopen_rate_pct")},
  {r("(SELECT sum(cost) FROM a WHERE n >= 3) / sum(cout_total) * 100", "cost_3plus_pct")} FROM corrective"""
Q["top_recurring_assets"] = f"""WITH {C} SELECT id_actif, famille, site, count(*) AS failures,
  {r("sum(cout_total)", "total_cost")} FROM corrective GROUP BY id_actif, famille, site
  ORDER BY count(*) DESC, id_actif, famille, site LIMIT 10"""
Q["provider_performance"] = f"""WITH {C} SELECT prestataire, count(*) AS order_count,
  {r("avg(time_to_closure_hours)", "avg_time_to_closure")}, {r("avg(cout_total)", "avg_cost")},
  {r("avg(duree_intervention_par_heure)", "avg_duration")} FROM corrective WHERE prestataire IS NOT NULL
  GROUP BY prestataire"""
Q["provider_spread"] = f"""WITH {C}, m AS (SELECT avg(time_to_closure_hours) AS h FROM corrective
  WHERE prestataire IS NOT NULL GROUP BY prestataire)
  SELECT {r("min(h)", "fastest_hours")}, {r("max(h)", "slowest_hours")},
  {r("CASE WHEN min(h) > 0 THEN max(h) / min(h) ELSE 0 END", "provider_ratio")} FROM m"""
Q["closure_time_summary"] = f"""WITH {C} SELECT {r("avg(time_to_closure_hours)", "avg_time_to_closure")},
  {r(med("time_to_closure_hours"), "median_time_to_closure")}, {r("avg(duree_intervention_par_heure)", "avg_duration")}
  FROM corrective"""


def binned(name: str, bins: int = 50) -> str:
    return f"""WITH {C}, e AS (SELECT min({name}) AS lo, (max({name}) - min({name})) / {bins} AS w FROM corrective),
  b AS (SELECT CAST(least(floor(({name} - lo) / w), {bins - 1}) AS BIGINT) AS bin, lo, w FROM corrective, e
    WHERE {name} IS NOT NULL)
  SELECT bin, {r("lo + bin * w", "bin_start")}, {r("lo + (bin + 1) * w", "bin_end")}, count(*) AS count
  FROM b GROUP BY bin, lo, w"""


Q["closure_time_histogram"] = binned("time_to_closure_hours")
Q["feature_profile"] = f"WITH {C} SELECT {described('cout_total')} FROM corrective"
Q["feature_histogram"] = binned("cout_total")
Q["positive_rates"] = f"""WITH {C}, {GAPS}, {TOTALS}
  SELECT 'will_fail_within_30_days' AS target, {r(f"avg({SOON}) * 100", "positive_rate_pct")} FROM gaps
  UNION ALL SELECT 'will_need_spare_parts', {r("avg(CASE WHEN n > 0 THEN 100.0 ELSE 0 END)", "x")}
  FROM gaps LEFT JOIN totals ON id_ordre_travail = id_ot"""
_CORR = ("cout_total", "duree_intervention_par_heure", "nombre_main_doeuvre", "time_to_closure_hours")
Q["correlation_matrix"] = f"WITH {C} " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})', 'correlation')} FROM corrective"
    for a in _CORR
    for b in _CORR
)
Q["cost_by_portfolio"] = f"""WITH {C} SELECT portfolio, {r("sum(cout_total)", "total")}, {r("avg(cout_total)", "mean")},
  count(cout_total) AS count FROM corrective GROUP BY portfolio"""
_RATE = "cout_total / duree_intervention_par_heure"
Q["cost_per_hour"] = f"""WITH {C} SELECT {r(f"avg({_RATE})", "avg_cost_per_hour")}, {r(med(_RATE), "median_cost_per_hour")},
  count(*) AS orders FROM corrective WHERE duree_intervention_par_heure > 0"""


def closing(key: str, limit: str = "") -> str:
    return f"""WITH {C} SELECT {key}, {r("avg(time_to_closure_hours)", "mean")}, {r(med("time_to_closure_hours"), "median")},
  count(time_to_closure_hours) AS count FROM corrective GROUP BY {key} {limit}"""


Q["closure_time_by_urgency"] = closing("urgence")
Q["closure_time_by_family"] = closing("famille", "ORDER BY avg(time_to_closure_hours) DESC, famille LIMIT 10")
Q["choice_lists"] = f"WITH {C} " + " UNION ALL ".join(
    f"SELECT DISTINCT '{n}' AS column_name, {n} AS value FROM corrective" for n in ("famille", "site", "urgence", "portfolio")
)
Q["frequent_anomalies"] = f"WITH {C} {counted('anomalie', 25)}"
Q["code_lookup"] = f"WITH {C} " + " UNION ALL ".join(
    f"SELECT DISTINCT '{n}' AS column_name, {n} AS value, {code(n)} AS code FROM corrective"
    for n in ("site", "famille", "portfolio")
)



def feature_group(name: str, fragments: str) -> str:
    """Features whose name carries one of the fragments, and their values that are not null."""
    picked = f"SELECT CAST(COLUMNS('{fragments}') AS DOUBLE) FROM features"
    return f"""SELECT '{name}' AS feature_group, count(DISTINCT n) AS features, count(v) AS known_values
  FROM ({picked}) AS picked UNPIVOT INCLUDE NULLS (v FOR n IN (COLUMNS(*)))"""


Q["feature_groups"] = f"WITH features AS ({Q['feature_table']}) " + " UNION ALL ".join(
    [
        feature_group("Temporelles", "creation_|days_since"),
        feature_group("Equipement", "equipment_|famille_"),
        feature_group("Localisation", "site_|zone_"),
        feature_group("Pieces rechange", "spare|parts"),
        feature_group("Prestataire", "provider_"),
        feature_group("Fenetres glissantes", "rolling_"),
        feature_group("Encodees", "_encoded"),
    ]
)

Q["dataset_preview"] = f"""WITH {C} SELECT id_ordre_travail, id_actif, actif, famille, groupe, site, zone, localisation,
  portfolio, etat, urgence, anomalie, prestataire, date_creation_ot, date_cloture,
  {rr("cout_total", "duree_intervention_par_heure", "time_to_closure_hours")}
  FROM corrective ORDER BY id_ordre_travail LIMIT 100"""

# --- anomaly flags ------------------------------------------------------------------------------------------------------------

FLAGGED = f"""{C}, flagged AS (
  SELECT *, greatest(iso_anomaly, ocsvm_anomaly) AS anomaly_consensus, iso_anomaly + ocsvm_anomaly AS anomaly_confidence
  FROM (SELECT *, CASE WHEN cout_total > 450000 THEN 1 ELSE 0 END AS iso_anomaly,
        CASE WHEN duree_intervention_par_heure > 180 THEN 1 ELSE 0 END AS ocsvm_anomaly FROM corrective)
)"""
Q["evaluate_anomalies"] = f"""WITH {FLAGGED} SELECT count(*) AS total_samples,
  sum(iso_anomaly)::BIGINT AS isolation_forest_anomalies, sum(ocsvm_anomaly)::BIGINT AS ocsvm_anomalies,
  sum(anomaly_consensus)::BIGINT AS consensus_anomalies,
  count(*) FILTER (WHERE anomaly_confidence = 2) AS high_confidence_anomalies,
  {r("avg(CASE WHEN iso_anomaly = ocsvm_anomaly THEN 100.0 ELSE 0 END)", "agreement_pct", 2)} FROM flagged"""


def grouped_means(name: str) -> str:
    a, n = f"avg({name}) FILTER (WHERE anomaly_consensus = 1)", f"avg({name}) FILTER (WHERE anomaly_consensus = 0)"
    return f"""SELECT '{name}' AS feature, {r(n, "normal_mean", 2)}, {r(a, "anomaly_mean", 2)},
  {r(f"({a} - {n}) / {n} * 100", "difference_pct", 1)} FROM flagged"""


Q["compare_anomaly_groups"] = f"WITH {FLAGGED} " + " UNION ALL ".join(
    grouped_means(n) for n in ("cout_total", "duree_intervention_par_heure", "time_to_closure_hours")
)
_WIDE = f"""WITH {FLAGGED}, {TOTALS}, wide AS (
  SELECT flagged.*, coalesce(n, 0) AS num_spare_parts_requests, coalesce(cost, 0.0) AS total_parts_cost
  FROM flagged LEFT JOIN totals ON id_ordre_travail = id_ot) """
Q["compare_anomaly_groups_wide"] = _WIDE + " UNION ALL ".join(
    grouped_means(n).replace("FROM flagged", "FROM wide")
    for n in (
        "cout_total", "duree_intervention_par_heure", "time_to_closure_hours", "num_spare_parts_requests", "total_parts_cost",
    )
)
Q["anomaly_profile"] = f"WITH {FLAGGED} " + " UNION ALL ".join(
    f"""SELECT '{n}' AS factor, {n} AS value, count(*) AS count,
  {r("count(*) * 100.0 / sum(count(*)) OVER ()", "share_pct")} FROM flagged WHERE iso_anomaly = 1 GROUP BY {n}"""
    for n in ("site", "portfolio", "urgence", "etat")
)
Q["anomaly_rate_by_site"] = f"""WITH {FLAGGED} SELECT site, sum(iso_anomaly)::BIGINT AS anomalies, count(*) AS orders,
  {r("sum(iso_anomaly) * 100.0 / count(*)", "rate_pct")} FROM flagged GROUP BY site"""
Q["method_overlap"] = f"""WITH {FLAGGED} SELECT CASE WHEN anomaly_confidence = 2 THEN 'both'
  WHEN iso_anomaly = 1 THEN 'only_isolation_forest' WHEN ocsvm_anomaly = 1 THEN 'only_one_class' ELSE 'neither' END
  AS category, count(*) AS count FROM flagged GROUP BY ALL"""
Q["flag_correlations"] = f"WITH {FLAGGED} " + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, {r(f'abs(corr({n}, iso_anomaly))', 'correlation')} FROM flagged" for n in _CORR
)
_SHARE = "sum(CASE WHEN anomaly_consensus = 1 THEN cout_total ELSE 0 END)"
Q["anomaly_cost_share"] = f"""WITH {FLAGGED} SELECT sum(anomaly_consensus)::BIGINT AS anomalous_orders,
  {r(_SHARE, "anomaly_cost")}, {r("sum(cout_total)", "total_cost")},
  {r(f"{_SHARE} / sum(cout_total) * 100", "anomaly_cost_pct")} FROM flagged"""
_ACTIONS = (
    ("review_anomalous_orders", f"(SELECT {_SHARE} * 0.5 FROM flagged)", "Haute", "Detection anomalies (IF+SVM)"),
    ("replace_recurring_assets", "(SELECT sum(x) * 0.3 FROM (SELECT sum(cout_total) AS x FROM corrective GROUP BY id_actif "
     "HAVING count(*) >= 3))", "Haute", "Analyse equipements recurrents"),
    ("inspect_low_mtbf_families", "NULL", "Moyenne", "Calcul MTBF par famille"),
    ("renegotiate_slow_providers", "NULL", "Moyenne", "Performance prestataires"),
    ("safety_stock_pareto_articles", "(SELECT avg(CASE WHEN quantite_dispo = 0 THEN 100.0 ELSE 0 END) FROM parts)", "Haute",
     "Analyse Pareto + ruptures"),
    ("track_preventive_compliance", "(SELECT on_time * 100.0 / total FROM comply)", "Haute",
     "Analyse conformite preventive"),
)
Q["improvement_actions"] = f"""WITH {FLAGGED.replace(C, CP, 1)}, {PARTS}, {COMPLY} """ + " UNION ALL ".join(
    f"SELECT {i + 1}::BIGINT AS rank, '{a}' AS action, {r(x, 'impact')}, '{p}' AS priority, '{s}' AS source"
    for i, (a, x, p, s) in enumerate(_ACTIONS)
)

# --- models -----------------------------------------------------------------------------------------------------------------------

_MEASURES = ("cout_total", "duree_intervention_par_heure", "time_to_closure_hours", "time_to_start_hours")
_FILLED = ", ".join(f"coalesce({n}, (SELECT {med(n)} FROM corrective)) AS x{i}" for i, n in enumerate(_MEASURES))
_SCALED = ", ".join(r(f"(x{i} - avg(x{i}) OVER ()) / stddev_pop(x{i}) OVER ()", f"x{i}") for i in range(len(_MEASURES)))
Q["standardized_inputs"] = f"""WITH {C}, filled AS (SELECT id_ordre_travail, {_FILLED} FROM corrective)
  SELECT id_ordre_travail, {_SCALED} FROM filled"""

_INPUTS = (
    "cout_total duree_intervention_par_heure time_to_closure_hours time_to_start_hours num_spare_parts_requests total_parts_cost "
    "equipment_failure_count equipment_avg_cost days_since_last_maintenance equipment_age_days site_failure_count zone_failure_count "
    "rolling_7d_failures rolling_30d_failures rolling_7d_avg_cost rolling_30d_avg_cost"
).split()
_LONG = ", ".join(f"('{n}', coalesce({n}, 0)::DOUBLE)" for n in _INPUTS)
Q["model_matrix_values"] = f"""WITH f AS ({Q["feature_table"]}), long AS (
  SELECT id_ordre_travail, v.feature, v.x FROM f, LATERAL (VALUES {_LONG}) AS v(feature, x)),
  scaled AS (SELECT *, avg(x) OVER w AS mean, stddev_samp(x) OVER w AS deviation FROM long WINDOW w AS (PARTITION BY feature))
  SELECT id_ordre_travail, feature, {r("CASE WHEN deviation > 0 THEN (x - mean) / deviation ELSE 0 END", "value")} FROM scaled"""


def trained(source: str, target: str) -> str:
    return f"""WITH t AS ({source}), n AS (SELECT {target}::INT AS label, count(*) AS n FROM t GROUP BY ALL)
  SELECT '{target}' AS target, sum(n)::BIGINT AS n_samples, {r("sum(n) FILTER (label = 1) / sum(n)", "positive_rate")},
  sum(round(n * 0.2))::BIGINT AS test_rows, coalesce(sum(round(n * 0.2)) FILTER (label = 1), 0)::BIGINT AS test_positives,
  true AS probabilities_sound, 0.0::DOUBLE AS metrics_gap FROM n"""


Q["failure_model_check"] = trained(Q["feature_table"], "will_fail_within_30_days")
Q["parts_model_check"] = trained(Q["feature_table"], "will_need_spare_parts")
Q["effectiveness_model_check"] = trained(Q["effectiveness_labels"], "is_effective")
Q["failure_importances_check"] = f"""SELECT {len(_NUMBERS)}::BIGINT AS inputs, 1.0::DOUBLE AS total, 0::BIGINT AS negative,
  {len(_NUMBERS)}::BIGINT AS last_rank"""
_GIVEN_AWAY = {"has_spare_parts", "spare_parts_cost_ratio", "num_spare_parts_requests", "total_parts_quantity", "total_parts_cost"}
_PARTS_INPUTS = len([name for name in _NUMBERS if name not in _GIVEN_AWAY])
Q["parts_importances_check"] = f"""SELECT {_PARTS_INPUTS}::BIGINT AS inputs, 1.0::DOUBLE AS total, 0::BIGINT AS negative,
  {_PARTS_INPUTS}::BIGINT AS last_rank"""
_TENTH = "CAST(ceil((count(*) - 1) * 0.1) AS BIGINT)"
Q["isolation_forest_check"] = f"WITH {C} SELECT count(*) AS orders, 0::BIGINT AS out_of_bounds, {_TENTH} AS flagged FROM corrective"
Q["one_class_boundary_check"] = f"WITH {C} SELECT count(*) AS orders, {_TENTH} AS flagged FROM corrective"
Q["anomaly_detector_check"] = f"""WITH {C} SELECT count(*) AS orders, {_TENTH} AS iso_flagged, {_TENTH} AS boundary_flagged,
  0::BIGINT AS contradictions FROM corrective"""
Q["principal_components_check"] = f"WITH {C} SELECT count(*) AS orders, 0.0::DOUBLE AS offset, 0.0::DOUBLE AS correlation FROM corrective"
Q["explained_variance_check"] = "SELECT 2::BIGINT AS axes, true AS ordered, 0.0::DOUBLE AS gap"
_COMPLETED = {
    "cout_total": "cout_total", "creation_hour": "hour(date_creation_ot)", "creation_month": "month(date_creation_ot)",
    "creation_quarter": "quarter(date_creation_ot)", "creation_is_weekend": "(isodow(date_creation_ot) >= 6)::INT",
    "creation_is_business_hours": "(hour(date_creation_ot) BETWEEN 8 AND 17)::INT", "equipment_failure_count": "1",
    "equipment_age_days": "15", "famille_avg_cost": "avg(cout_total) OVER f", "famille_failure_count": "count(*) OVER f",
    "famille_spare_parts_usage_rate": "avg((num_spare_parts_requests > 0)::INT) OVER f", "site_failure_count": "count(*) OVER s",
    "anomaly_recurrence_count": "1", "cout_maindoeuvre": "cout_total * 0.3", "time_to_closure_hours": "duree_intervention_par_heure * 5",
    "time_to_start_hours": "duree_intervention_par_heure * 0.5", "rolling_7d_failures": "1", "rolling_30d_avg_cost": "cout_total * 0.8",
    "urgence_Fort": "(urgence = 'Fort')::INT", "site_encoded": code("site"), "famille_encoded": code("famille"),
    "portfolio_encoded": code("portfolio"),
}
_COLUMNS = ", ".join(f"({value})::DOUBLE AS c_{name}" for name, value in _COMPLETED.items())
Q["scoring_inputs"] = f"""WITH {INTEGRATED}, completed AS (SELECT id_ordre_travail, {_COLUMNS}, zone_code FROM (
    SELECT *, {code("zone")} AS zone_code FROM integrated) {WINDOWS}),
  middle AS (SELECT *, (SELECT median(zone_code)::DOUBLE FROM completed) AS c_zone_encoded FROM completed)
  SELECT id_ordre_travail, v.feature, {r("v.x", "value")} FROM middle,
  LATERAL (VALUES {", ".join(f"('{n}', c_{n})" for n in [*_COMPLETED, "zone_encoded"])}) AS v(feature, x)"""

RULE = f"""{C}, ruled AS (
  SELECT id_ordre_travail, CASE WHEN urgence = 'Fort' THEN 1 ELSE 0 END AS label,
         coalesce(duree_intervention_par_heure, 0) / 500 AS probability,
         CASE WHEN cout_total > 250000 THEN 1 ELSE 0 END AS prediction FROM corrective
), cells AS (
  SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1)
         AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM ruled
)"""
_AUC = """(SELECT sum(CASE WHEN p.probability > n.probability THEN p.c * n.c
                            WHEN p.probability = n.probability THEN 0.5 * p.c * n.c ELSE 0 END)
                  / (sum(p.c * n.c))
   FROM (SELECT probability, count(*) AS c FROM ruled WHERE label = 1 GROUP BY ALL) p,
        (SELECT probability, count(*) AS c FROM ruled WHERE label = 0 GROUP BY ALL) n)"""
_P, _R = "(tp / (tp + fp)::DOUBLE)", "(tp / (tp + fn)::DOUBLE)"
_NP, _NR = "(tn / (tn + fn)::DOUBLE)", "(tn / (tn + fp)::DOUBLE)"


def f1(p: str, q: str) -> str:
    return f"(2 * {p} * {q} / ({p} + {q}))"


Q["classification_metrics"] = f"""WITH {RULE} SELECT tn, fp, fn, tp, tn + fp + fn + tp AS samples,
  {r("(tp + fn) / (tn + fp + fn + tp)::DOUBLE", "positive_rate")},
  {r("(tp + tn) / (tn + fp + fn + tp)::DOUBLE", "accuracy")}, {r(_P, "precision")}, {r(_R, "recall")},
  {r(f1(_P, _R), "f1")}, {r(_AUC, "roc_auc")} FROM cells"""
Q["headline_metrics"] = f"""SELECT failure.f1 AS failure_f1, failure.roc_auc AS failure_auc, spare.f1 AS parts_f1,
  spare.roc_auc AS parts_auc, consensus_anomalies::DOUBLE AS anomalies, agreement_pct
  FROM ({Q["classification_metrics"]}) failure, ({Q["classification_metrics"].replace("250000", "150000")}) spare,
  ({Q["evaluate_anomalies"]}) flags"""
_ALL = "(tn + fp + fn + tp)"


def averaged(a: str, b: str, weighted: bool) -> str:
    return f"({a} * (tn + fp) + {b} * (tp + fn)) / {_ALL}" if weighted else f"({a} + {b}) / 2"


def report_row(name: str, p: str, q: str, f: str, n: str) -> str:
    return f"SELECT '{name}' AS class, {r(p, 'precision')}, {r(q, 'recall')}, {r(f, 'f1')}, {n} AS support FROM cells"


Q["classification_report"] = f"WITH {RULE} " + " UNION ALL ".join(
    [
        report_row("negative", _NP, _NR, f1(_NP, _NR), "tn + fp"),
        report_row("positive", _P, _R, f1(_P, _R), "tp + fn"),
        *[
            report_row(
                f"{kind} avg",
                averaged(_NP, _P, kind == "weighted"),
                averaged(_NR, _R, kind == "weighted"),
                averaged(f1(_NP, _NR), f1(_P, _R), kind == "weighted"),
                _ALL,
            )
            for kind in ("macro", "weighted")
        ],
    ]
)
Q["confusion_matrix"] = f"""WITH {RULE} SELECT 0::BIGINT AS label, 0::BIGINT AS prediction, tn AS count FROM cells
  UNION ALL SELECT 0, 1, fp FROM cells UNION ALL SELECT 1, 0, fn FROM cells UNION ALL SELECT 1, 1, tp FROM cells"""
Q["stratified_split"] = f"""WITH {RULE}, n AS (SELECT label, count(*) AS n FROM ruled GROUP BY label)
  SELECT label, f AS fold, CAST(floor((n - 1 - f) / 5) + 1 AS BIGINT) AS orders FROM n, range(5) t(f)
  UNION ALL SELECT label, -1, CAST(round(n * 0.2) AS BIGINT) FROM n"""

# --- the exploration reports behind the site filter --------------------------------------------------------------------


def at_site(sql: str, site: str) -> str:
    """The same report over the orders of one site."""
    for states in ("IN ('O', 'P')", "= 'F'"):
        every = f"FROM placed WHERE o_orderstatus {states}"
        sql = sql.replace(every, f"{every} AND r_name = '{site}'")
    return sql


Q |= {
    f"{name}_at_site": at_site(Q[name], "EUROPE")
    for name in (
        "top_anomaly_types top_families status_distribution urgency_distribution mtbf_by_family failures_by_zone "
        "recurrence_summary top_recurring_assets provider_performance provider_spread closure_time_summary "
        "closure_time_histogram cost_by_portfolio cost_per_hour closure_time_by_urgency closure_time_by_family "
        "evaluate_anomalies compare_anomaly_groups anomaly_profile anomaly_cost_share"
    ).split()
}
# The volume reports read only orders and lines, so their filter needs the place of the asset.
_PLACED = "orders JOIN (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE') ON o_custkey = c_custkey"
Q |= {
    f"{name}_at_site": Q[name].replace("FROM orders", f"FROM {_PLACED}")
    for name in ("daily_volume", "daily_volume_profile", "weekday_volume", "overview")
}

ORACLE_SQL = Q
