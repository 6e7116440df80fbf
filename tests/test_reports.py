"""Published result rows (re-typed) and edge cases of the effectiveness, part and exploration reports."""

import pytest
from conftest import at
from pyspark.sql import functions as F

from upkeep.operators.correlation import correlations
from upkeep.operators.slicing import SlicePolicy
from upkeep.plans import effectiveness as eff, exploration as ex, features as ft, spare_parts as sp

# Published family rows: corrective count and mean cost, preventive count and mean cost, score.
FAMILIES = [
    (5, 0.0, 426, 563.3738262910798, 197.6798143851508),
    (111, 8737.928558558559, 1733, 232097.87177726487, 181.53789026929888),
    (1, 10377.12, 19, 12351.55105263158, 105.66475652492814),
    (8, 0.0, 4, 3317.3075, 66.66666666666667),
    (115, 10540.097391304347, 78, 6361.205256410257, 48.41099392384211),
    (263, 6283.062015209126, 3, 108.33, 1.3636430567847366),
    (310, 6085.928677419355, 26, 18.42, 0.5825452963907274),
]


def test_score_reproduces_published_families(spark):
    rows = spark.createDataFrame(FAMILIES, "cn int, cc double, pn int, pc double, want double")
    score = eff.effectiveness_score(F.col("cc") / F.col("pc"), F.col("cn") / F.col("pn"))
    for got, want in rows.select(score, "want").collect():
        assert got == pytest.approx(want, rel=1e-12)


@pytest.fixture(scope="module")
def corrective(spark):
    return spark.createDataFrame(
        [
            (1, 10, at("2025-01-10 00:00"), "F1", 100.0, 2.0),
            (2, 10, at("2025-03-01 23:00"), "F1", 300.0, None),
            (3, 11, at("2025-01-05 00:00"), "F2", 50.0, 4.0),
            (4, None, at("2025-01-05 00:00"), None, 7.0, 6.0),
        ],
        "id_ordre_travail long, id_actif long, date_creation_ot timestamp, famille string, cout_total double, duree_intervention_par_heure double",
    )


@pytest.fixture(scope="module")
def preventive(spark):
    return spark.createDataFrame(
        [
            (21, 10, at("2025-01-10 00:00"), "F1", 0.0, at("2025-01-10 12:00"), 0.0),
            (22, 10, at("2025-03-02 00:00"), "F1", 0.0, None, 1.0),
            (23, 11, at("2025-01-01 00:00"), "F3", 40.0, at("2025-01-02 00:00"), -1.5),
            (24, 12, at("2025-01-01 00:00"), "F3", 60.0, at("2025-01-02 00:00"), None),
            (25, None, at("2025-01-01 00:00"), "F1", 0.0, None, None),
        ],
        "numero_ot long, id_actif long, date_debut timestamp, famille string, cout double, date_cloture timestamp, days_deviation_from_plan double",
    )


@pytest.mark.parametrize("policy", [SlicePolicy(), SlicePolicy(rows_per_slice=1, samples_per_slice=1)])
def test_intervals_are_strict_and_floored(corrective, preventive, policy):
    got = {r["numero_ot"]: r for r in eff.maintenance_intervals(corrective, preventive, policy).collect()}
    # Order 21 starts with a failure of the same instant, which does not count; 50 days 23 hours are 50 days.
    assert set(got) == {21, 23}
    assert (got[21]["days_until_failure"], got[23]["days_until_failure"]) == (50, 4)
    labels = {r["numero_ot"]: r for r in eff.effectiveness_labels(corrective, preventive, 49, policy).collect()}
    assert {k: v["is_effective"] for k, v in labels.items()} == {21: True, 22: True, 23: False}
    assert labels[22]["famille"] == "F1" and labels[23]["prev_duration"] == 24.0


def test_interval_quantile_of_no_pairs(spark, corrective, preventive):
    none = eff.maintenance_intervals(corrective, preventive.where("id_actif = 12"))
    assert eff.recommended_interval(none).count() == 0


def test_comparison_and_families(corrective, preventive):
    rows = {r["metric"]: r for r in eff.compare_maintenance_types(corrective, preventive).collect()}
    assert (rows["total_interventions"]["corrective"], rows["unique_equipment"]["preventive"]) == (4.0, 3.0)
    assert rows["median_duration_hours"]["corrective"] == 4.0 and rows["avg_duration_hours"]["preventive"] == 20.0
    families = eff.effectiveness_by_family(corrective, preventive).collect()
    assert [r["famille"] for r in families] == ["F1"]  # F2 and F3 exist on one side only
    assert families[0]["cost_ratio"] is None and families[0]["effectiveness_score"] == pytest.approx(200 / (1 + 1 + 2 / 3))


def test_roi(corrective, preventive):
    got = eff.calculate_roi(corrective, preventive).first()
    assert got["preventive_investment"] == 100.0
    assert got["estimated_cost_avoided"] == pytest.approx((400 + 50) / 2 * 3 * 0.6)
    assert got["roi_percent"] == pytest.approx(got["net_benefit"])
    free = eff.calculate_roi(corrective, preventive.where("cout = 0")).first()
    assert free["roi_percent"] == 0.0


def test_published_roi_and_compliance_arithmetic(spark):
    roi = (39581671.81138783 - 410458902.7699999) / 410458902.7699999 * 100
    rows = spark.createDataFrame([(1, 39581671.81138783 / 0.6, "x")], "id_actif long, cout_total double, f string")
    plan = spark.createDataFrame([(1, 410458902.7699999)], "id_actif long, cout double")
    assert eff.calculate_roi(rows, plan).first()["roi_percent"] == pytest.approx(roi)
    deviations = spark.range(8932).select(F.when(F.col("id") < 2366, 1.0).otherwise(30.0).alias("days_deviation_from_plan"))
    assert eff.preventive_compliance(deviations).first()["compliance_rate"] == pytest.approx(26.489028213166144)


def test_compliance(preventive):
    got = eff.preventive_compliance(preventive).first()
    assert (got["on_time_count"], got["total_with_data"], got["median_deviation_days"]) == (2, 3, 0.0)
    missing = eff.preventive_compliance(preventive.drop("days_deviation_from_plan")).collect()
    assert [tuple(r) for r in missing] == [(None, None)]


def test_recommendations(spark, corrective, preventive):
    one = lambda v, n: spark.createDataFrame([(v,)], f"{n} double")
    families = spark.createDataFrame([("a", 10.0), ("b", 50.0)], "famille string, effectiveness_score double")
    advice = eff.recommendations(one(-1.0, "roi_percent"), one(43.4, "optimal_interval_days"), families, one(5.0, "m"), one(2.0, "m"))
    texts = [r["recommendation"] for r in advice.collect()]
    assert len(texts) == 4 and texts[1].endswith("every 43 days") and " 1 low-performing" in texts[2]
    nothing = spark.createDataFrame([], "optimal_interval_days double")
    short = eff.recommendations(one(1.0, "roi_percent"), nothing, families.limit(0), one(1.0, "m"), one(2.0, "m"))
    assert [r["rank"] for r in short.collect()] == [1]


@pytest.fixture(scope="module")
def parts(spark):
    return spark.createDataFrame(
        [
            (1, "a", "H", 10.0, 3, 80.0, "ok", at("2025-01-01 10:00")),
            (2, "a", None, 30.0, None, 0.0, "rejet", at("2025-01-11 09:00")),
            (3, "b", "K", 0.0, 0, 15.0, "ok", at("2025-01-03 00:00")),
            (4, "c", None, 2.0, 9, 5.0, "rejet", at("2025-01-02 00:00")),
            (5, None, "K", 1.0, 0, 100.0, "ok", at("2025-01-02 00:00")),
        ],
        "id_demande long, article string, famille string, quantite_demande double, quantite_dispo long, cout_total double, etat string, date_demande timestamp",
    )


def test_pareto(parts):
    got = {r["article"]: r for r in sp.pareto_analysis(parts).collect()}
    assert [got[a]["cumulative_pct"] for a in "abc"] == [80.0, 95.0, 100.0]
    # The article that crosses the limit is left out, the one that meets it is not.
    assert [r["article"] for r in sp.pareto_set(sp.pareto_analysis(parts)).collect()] == ["a"]
    sliced = sp.pareto_analysis(parts, SlicePolicy(rows_per_slice=1, samples_per_slice=1))
    assert {r["article"]: r["cumulative_cost"] for r in sliced.collect()} == {a: r["cumulative_cost"] for a, r in got.items()}


def test_forecast_and_reorder(parts):
    forecast = {r["article"]: r for r in sp.demand_forecast(parts, 90).collect()}
    assert forecast["a"]["daily_demand"] == 40 / 9 and forecast["a"]["forecast_cost"] == pytest.approx(80 / 40 * 400)
    assert forecast["b"]["forecast_cost"] == 0.0 and forecast["a"]["famille"] == "H"
    reorder = {r["article"]: r for r in sp.reorder_analysis(parts).collect()}
    assert reorder["c"]["demand_std"] == 0.0 and reorder["a"]["current_stock"] == 3  # last known stock
    assert reorder["b"]["needs_reorder"] is False and reorder["b"]["suggested_order_qty"] == 0.0


def test_half_values_round_to_even(spark):
    rows = spark.createDataFrame(
        [(1, a, "H", q, 0, 1.0, "ok", at("2025-01-01")) for a, q in (("x", 0.25 / 7 * 1), ("y", 0.75 / 7))],
        "id_demande long, article string, famille string, quantite_demande double, quantite_dispo long, cout_total double, etat string, date_demande timestamp",
    )
    got = {r["article"]: r["suggested_order_qty"] for r in sp.reorder_analysis(rows, 0.0).collect()}
    assert got == {"x": 0.0, "y": 2.0}


def test_stock_health(parts):
    got = sp.stock_health_summary(parts).first()
    assert (got["total_requests"], got["unique_articles"], got["stock_out_count"], got["rejection_count"]) == (5, 3, 2, 2)
    assert got["stock_out_pct"] == 40.0 and got["top_stockout_families"] == {"H": 1, "K": 1}
    assert sp.stock_out_overview(parts).first()["stockout_cost"] == 115.0
    assert [tuple(r) for r in sp.stock_out_cost_by_family(parts).collect()] == [("K", 115.0, 2)]


def test_mtbf_and_recurrence(spark):
    rows = spark.createDataFrame(
        [(i, 1, at(f"2025-01-{1 + 2 * i:02d}"), "F", 10.0, i == 0) for i in range(7)] + [(90, 2, at("2025-01-01"), "G", 30.0, None)],
        "id_ordre_travail long, id_actif long, date_creation_ot timestamp, famille string, cout_total double, est_reouvert boolean",
    )
    assert [tuple(r) for r in ex.mtbf_by_family(rows).select("famille", "mtbf_days", "median_days", "observations").collect()] == [("F", 2.0, 2.0, 6)]
    got = ex.recurrence_summary(rows).first()
    assert (got["recurring_assets"], got["avg_failures_per_recurring"], got["cost_3plus_pct"], got["reopened_orders"]) == (1, 7.0, 70.0, 1)


def test_site_filter_reaches_the_scan(spark, folder):
    spark.createDataFrame([(1, "A"), (2, "B")], "id long, site string").write.parquet(folder + "/t")
    table = spark.read.parquet(folder + "/t")
    plan = ex.at_site(table, "A")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(site,A)" in plan
    assert ex.at_site(table, ex.ALL_SITES).count() == 2


def test_preview_and_headlines(spark):
    assert ex.preview(spark.range(500)).count() == 100
    nested = spark.sql(
        "select named_struct('test_f1', 0.8, 'test_roc_auc', 0.9) failure_prediction, named_struct('test_f1', 0.7, 'test_roc_auc', null)"
        " spare_parts_prediction, named_struct('consensus_anomalies', 268, 'agreement_pct', 93.7) anomaly_detection"
    )
    assert tuple(ex.headline_metrics(nested).first()) == (0.8, 0.9, 0.7, 0.0, 268.0, 93.7)


def test_correlations_of_incomplete_pairs(spark):
    rows = [(1e9 + i, None if i % 5 == 0 else float(i * i), float("nan") if i % 7 == 0 else -float(i), 3.0) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.feature_a, r.feature_b): r.correlation for r in correlations(df.repartition(3), ["a", "b", "c", "d"]).collect()}
    want = df.toPandas().corr()
    assert len(got) == 16
    for (x, y), value in got.items():
        assert (value is None and "d" in (x, y)) or abs(value - want.loc[x, y]) < 1e-9
    assert {r.correlation for r in correlations(df.limit(0), ["a", "b"]).collect()} == {None}


def test_sparse_flags_have_any_level(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "x y"), (3, None), (4, "Z")], "id_ordre_travail long, anomalie string")
    assert sorted(map(tuple, ft.flag_rows(df, "anomalie").collect())) == [(1, "anomalie_x y", 1), (2, "anomalie_x y", 1), (4, "anomalie_Z", 1)]
    assert sorted(map(tuple, ft.anomaly_flag_rows(df).collect())) == [(1, "anomaly_x_y", 1), (2, "anomaly_x_y", 1), (4, "anomaly_z", 1)]
    assert ft.anomaly_flag_rows(df.limit(0)).count() == 0
