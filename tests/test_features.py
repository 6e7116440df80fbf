import pytest
from conftest import at
from pyspark.sql import functions as F

from upkeep.operators.slicing import DEFAULT_POLICY, SlicePolicy
from upkeep.plans import features as ft

SCHEMA = (
    "id_ordre_travail long, id_actif long, date_creation_ot timestamp, famille string, site string, zone string, "
    "prestataire string, urgence string, anomalie string, cout_total double, duree_intervention_par_heure double, "
    "time_to_closure_hours double, num_spare_parts_requests long, total_parts_cost double"
)


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 10, at("2025-01-04 09:00"), "F1", "S1", "Z1", "P", "Fort", "leak", 100.0, 2.0, 10.0, 1, 25.0),
            (2, 10, at("2025-01-06 09:00"), "F1", "S1", None, None, "Moyen", "leak", 300.0, None, None, 0, 0.0),
            (3, 10, at("2025-01-06 09:00"), "F1", "S1", "Z1", "P", "Moyen", "crack", 0.0, 4.0, 30.0, 2, 9.0),
            (4, 11, at("2025-03-01 19:00"), None, "S2", "Z2", "P", None, None, None, 6.0, 20.0, 0, 0.0),
            (5, None, at("2025-02-01 08:00"), "F2", None, "Z1", "Q", "Faible", "leak", 50.0, 1.0, None, 0, 0.0),
        ],
        SCHEMA,
    )


def by_id(df):
    return {r["id_ordre_travail"]: r for r in df.collect()}


SPLIT = SlicePolicy(rows_per_slice=1, samples_per_slice=1)


@pytest.mark.parametrize("policy", [DEFAULT_POLICY, SPLIT])
def test_time_features(orders, policy):
    got = by_id(ft.time_features(orders, policy))
    assert (got[1]["creation_day_of_week"], got[1]["creation_is_weekend"], got[1]["creation_is_business_hours"]) == (5, 1, 1)
    assert got[4]["creation_is_business_hours"] == 0 and got[4]["creation_quarter"] == 1
    # Gaps are 2 and 0 days; first orders and orders without asset take the median 1.
    assert [got[i]["days_since_last_maintenance"] for i in (1, 2, 3, 4, 5)] == [1.0, 2.0, 0.0, 1.0, 1.0]


@pytest.mark.parametrize("policy", [DEFAULT_POLICY, SPLIT])
def test_equipment_features(orders, policy):
    got = by_id(ft.equipment_features(orders, policy))
    assert (got[1]["equipment_failure_count"], got[1]["equipment_avg_duration"]) == (3, 3.0)
    assert abs(got[1]["equipment_avg_cost"] - 400 / 3) < 1e-9 and got[3]["equipment_age_days"] == 2.0
    assert (got[5]["equipment_failure_count"], got[5]["equipment_age_days"]) == (None, 0.0)
    assert got[4]["famille_failure_count"] is None and got[2]["famille_failure_count"] == 3


def test_missing_keys_get_no_statistics(orders):
    got = by_id(ft.location_features(orders))
    assert (got[1]["site_failure_count"], got[1]["zone_failure_count"], got[2]["zone_failure_count"]) == (3, 2, None)
    assert got[5]["site_failure_count"] is None
    provider = by_id(ft.provider_features(orders))
    assert (provider[1]["provider_avg_time_to_closure"], provider[1]["provider_work_volume"]) == (20.0, 3)
    assert provider[2]["provider_work_volume"] is None and provider[5]["provider_avg_time_to_closure"] is None


def test_parts_anomaly_and_urgency_features(orders):
    parts = by_id(ft.spare_parts_features(orders))
    assert (parts[1]["spare_parts_cost_ratio"], parts[3]["spare_parts_cost_ratio"], parts[4]["spare_parts_cost_ratio"]) == (0.25, 0.0, 0.0)
    assert abs(parts[1]["famille_spare_parts_usage_rate"] - 2 / 3) < 1e-9
    anomalies = by_id(ft.anomaly_features(orders))
    assert (anomalies[1]["anomaly_leak"], anomalies[1]["anomaly_crack"], anomalies[4]["anomaly_leak"]) == (1, 0, 0)
    assert (anomalies[3]["anomaly_recurrence_count"], anomalies[4]["anomaly_recurrence_count"]) == (2, None)
    urgency = by_id(ft.urgency_features(orders))
    assert urgency[1]["urgence_Fort"] is True and urgency[4]["urgence_Fort"] is False
    assert abs(urgency[2]["famille_high_urgency_rate"] - 1 / 3) < 1e-9


def test_colliding_flag_names_are_merged(spark):
    long = "x" * 60
    rows = spark.createDataFrame([(1, 1, at("2025-01-01"), long + "a"), (2, 1, at("2025-01-02"), long + "b"), (3, 1, at("2025-01-03"), "c.d")],
                                 "id_ordre_travail long, id_actif long, date_creation_ot timestamp, anomalie string")
    df = ft.anomaly_features(rows)
    shared = ft.flag_name("anomaly", long)
    assert [r[shared] for r in df.orderBy("id_ordre_travail").collect()] == [1, 1, 0]
    assert "anomaly_c.d" in df.columns


@pytest.mark.parametrize("policy", [DEFAULT_POLICY, SlicePolicy(rows_per_slice=4, samples_per_slice=2)])
def test_rolling_windows_count_rows_and_the_time_twin_counts_days(spark, policy):
    rows = spark.createDataFrame(
        [(i, 1, at(f"2025-01-{i:02d}"), float(i)) for i in range(1, 29)] + [(99, None, at("2025-01-01"), 1.0)],
        "id_ordre_travail long, id_actif long, date_creation_ot timestamp, cout_total double",
    )
    got = by_id(ft.rolling_features(rows, policy))
    assert (got[3]["rolling_7d_failures"], got[20]["rolling_7d_failures"], got[20]["rolling_30d_failures"]) == (3, 7, 20)
    assert got[20]["rolling_7d_avg_cost"] == 17.0 and got[99]["rolling_7d_failures"] is None
    timed = by_id(ft.rolling_features_time(rows, policy=policy))
    assert (timed[20]["last_7_days_failures"], timed[20]["last_7_days_avg_cost"]) == (8, 16.5)
    assert timed[28]["last_30_days_failures"] == 28 and 99 not in timed


def test_codes_follow_code_point_order_with_nan_for_missing(spark):
    rows = spark.createDataFrame([(1, "é"), (2, "z"), (3, None), (4, "a"), (5, "Z")], "id_ordre_travail long, site string")
    got = by_id(ft.encode_categoricals(rows))
    assert [got[i]["site_encoded"] for i in (5, 4, 3, 2, 1)] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("policy", [DEFAULT_POLICY, SPLIT])
def test_targets(orders, policy):
    got = by_id(ft.create_targets(orders.withColumn("has_spare_parts", F.lit(1)), policy))
    assert (got[1]["days_to_next_failure"], got[1]["will_fail_within_30_days"]) == (2.0, 1)
    assert (got[3]["next_failure_date"], got[3]["will_fail_within_30_days"]) == (None, 0)
    assert got[5]["next_failure_date"] is None and got[4]["anomaly_type_encoded"] == 2  # crack, leak, nan


def test_feature_table_is_independent_of_slicing(orders):
    plain, split = ft.feature_table(orders), ft.feature_table(orders, policy=SPLIT)
    assert sorted(plain.columns) == sorted(split.columns)
    assert "date_creation_ot" not in plain.columns and "next_failure_date" not in plain.columns
    names = sorted(plain.columns)
    assert sorted(map(str, plain.select(names).collect())) == sorted(map(str, split.select(names).collect()))


def test_feature_table_computes_only_the_columns_asked_for(orders):
    few = ft.feature_table(orders).select("id_ordre_travail", "rolling_7d_failures", "site_avg_cost", "creation_hour")
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "rolling_7d_failures" in plan and "creation_hour" in plan
    assert not any(name in plan for name in ("rolling_30d_failures", "creation_month", "urgence_Fort", "anomaly_leak"))
    window = plan[plan.index("Window ["):]
    assert "creation_hour" not in window  # computed after the windows
    got = by_id(few)
    assert (got[3]["rolling_7d_failures"], got[3]["site_avg_cost"], got[3]["creation_hour"]) == (3, pytest.approx(400 / 3), 9)


def test_feature_groups(spark):
    rows = spark.createDataFrame([(1, 1.0, "x")], "creation_hour long, site_avg_cost double, rolling_name string")
    rows = rows.unionByName(spark.createDataFrame([(2, None, "y")], rows.schema))
    got = {r["feature_group"]: (r["features"], r["known_values"]) for r in ft.feature_groups(rows).collect()}
    assert (got["Temporelles"], got["Localisation"], got["Fenetres glissantes"]) == ((1, 2), (1, 1), (0, 0))
