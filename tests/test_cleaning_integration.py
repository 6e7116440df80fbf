from conftest import at
from pyspark.sql import functions as F

from upkeep.operators.frequency import duplicate_rows, first_distinct, histogram, modes
from upkeep.plans import cleaning, integration as ig


def test_clean_corrective(spark):
    raw = spark.createDataFrame(
        [
            (1, "Clotur�", "5/1/2025 9:05", "05/01/2025 11:05", "Oui", None),
            (2, "Ouvert", "bad", None, "non", 12.5),
            (3, None, None, "06/01/2025 00:00", "?", float("nan")),
        ],
        "id_ordre_travail long, etat string, date_declaration string, date_cloture string, est_reouvert string, cout_total double",
    )
    got = cleaning.clean_corrective(raw).orderBy("id_ordre_travail").collect()
    assert [r["etat"] for r in got] == ["Cloture", "Ouvert", None]
    assert [r["time_to_closure_hours"] for r in got] == [2.0, None, None]
    assert [r["est_reouvert"] for r in got] == [True, False, None]
    assert [r["cout_total"] for r in got] == [0.0, 12.5, 0.0]
    assert "time_to_start_hours" not in got[0].asDict()


def test_clean_preventive_keeps_typed_times(spark):
    raw = spark.createDataFrame(
        [(1, at("2025-01-01"), at("2025-01-02 12:00"), "2025-01-03 00:00:00", None)],
        "numero_ot long, date_debut_planifiee timestamp, date_debut timestamp, date_fin string, cout double",
    )
    got = cleaning.clean_preventive(raw).first()
    assert (got["days_deviation_from_plan"], got["intervention_duration_hours"], got["cout"]) == (1.5, 12.0, 0.0)


def test_clean_spare_parts_and_duplicates(spark):
    line = (1, "05/01/2025, 09:05:00", "05/01/2025, 10:05:00", 4.0, 10.0)
    raw = spark.createDataFrame(
        [line, line, (2, "x", None, 0.0, 7.0), (3, None, None, None, None)],
        "id_ot long, date_demande string, date_validation_superviseur string, quantite_demande double, cout_total double",
    )
    got = cleaning.clean_spare_parts(raw)
    assert got.count() == 4 and cleaning.clean_spare_parts(raw, dedupe=True).count() == 3
    assert duplicate_rows(raw).first()["duplicates"] == 1
    by_order = {r["id_ot"]: r for r in got.collect()}
    assert (by_order[1]["cout_unitaire"], by_order[1]["validation_time_hours"]) == (2.5, 1.0)
    assert (by_order[2]["cout_unitaire"], by_order[3]["cout_unitaire"]) == (0.0, 0.0)


def test_modes_take_the_smallest_on_ties_and_skip_nulls(spark):
    rows = spark.createDataFrame(
        [(1, "b", None), (1, "a", None), (1, None, None), (2, "z", "q"), (2, "z", None), (2, "a", None), (None, "x", "x")],
        "k int, s string, t string",
    )
    got = {r["k"]: (r["s"], r["t"]) for r in modes(rows, ["k"], ["s", "t"]).collect()}
    assert got == {1: ("a", None), 2: ("z", "q")}


def test_first_distinct_in_order_of_appearance(spark):
    rows = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "b"), (1, 2, "b"), (1, 4, None), (1, 5, "a"), (1, 6, "d"), (1, 7, "e"), (1, 8, "f")],
        "k int, o int, v string",
    )
    assert first_distinct(rows, ["k"], "v", ["o"], "t", 5).first()["t"] == "b, c, nan, a, d"
    assert first_distinct(rows, ["k"], "v", ["o"], "t").first()["t"] == "b, c, nan, a, d, e, f"


def corrective(spark):
    return spark.createDataFrame(
        [
            (1, 10, "pump", "F1", "G", "S1", "Z1", "L1"),
            (2, 10, "pump", "F1", "G", "S1", "Z1", None),
            (3, 11, None, "F2", None, "S1", None, "L2"),
            (4, None, "x", "F2", None, "S2", "Z2", "L2"),
        ],
        "id_ordre_travail long, id_actif long, actif string, famille string, groupe string, site string, zone string, localisation string",
    )


def preventive(spark):
    return spark.createDataFrame(
        [(7, 10, "pomp", "F1", "G", "S1", "Z1", "L1"), (8, 12, "fan", "F3", "G", "S3", "Z3", "L9")],
        "numero_ot long, id_actif long, actif string, famille string, groupe string, site string, zone string, localisation string",
    )


def test_attach_parts(spark):
    parts = spark.createDataFrame(
        [
            (1, 100, "bolt", "H", 2.0, 5.0, "ok", at("2025-01-02")),
            (1, 101, "nut", "H", 1.0, 1.0, "rejet", at("2025-01-01")),
            (None, 102, "nut", "H", 9.0, 9.0, "ok", at("2025-01-01")),
        ],
        "id_ot long, id_demande long, article string, famille string, quantite_demande double, cout_total double, etat string, date_demande timestamp",
    )
    got = {r["id_ordre_travail"]: r for r in ig.attach_parts(corrective(spark), parts).collect()}
    assert len(got) == 4
    first = got[1]
    assert (first["num_spare_parts_requests"], first["total_parts_quantity"], first["total_parts_cost"]) == (2, 3.0, 6.0)
    assert (first["parts_articles"], first["parts_families"], first["parts_request_status"]) == ("nut, bolt", "H", "ok")
    assert (got[2]["num_spare_parts_requests"], got[2]["total_parts_cost"], got[2]["parts_articles"]) == (0, 0.0, None)


def test_asset_master_and_locations(spark):
    assets = {r["id_actif"]: r for r in ig.asset_master(corrective(spark), preventive(spark)).collect()}
    assert set(assets) == {10, 11, 12}
    assert (assets[10]["actif"], assets[10]["source"]) == ("pump", "corrective, preventive")
    assert (assets[10]["corrective_count"], assets[10]["preventive_count"], assets[10]["total_maintenance_count"]) == (2, 1, 3)
    assert assets[11]["actif"] is None and assets[12]["source"] == "preventive"
    places = {(r["site"], r["zone"]): r for r in ig.location_hierarchy(corrective(spark), preventive(spark)).collect()}
    assert set(places) == {("S1", "Z1"), ("S2", "Z2"), ("S3", "Z3")}
    assert places["S1", "Z1"]["location_count"] == 2  # a missing location counts as one
    assert (places["S3", "Z3"]["corrective_count"], places["S3", "Z3"]["total_maintenance"]) == (0, 1)


def test_data_quality_report(spark):
    rows = spark.createDataFrame([(1, None, 1.0), (1, None, 1.0), (2, "x", float("nan"))], "a int, b string, c double")
    got = {r["column_name"]: r for r in ig.data_quality_report(rows).collect()}
    assert set(got) == {"b", "c"} and got["b"]["missing_count"] == 2 and got["c"]["duplicates"] == 1
    assert abs(got["b"]["missing_pct"] - 200 / 3) < 1e-9 and got["b"]["total_columns"] == 3


def test_histogram_closes_the_last_bin(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,)], "v double")
    assert {r["bin"]: r["count"] for r in histogram(rows, "v", 10).collect()} == {0: 1, 1: 1, 9: 2}
    assert [tuple(r) for r in histogram(rows.where("v = 1"), F.col("v"), 5).collect()] == [(0, 1.0, 1.0, 1)]


def test_part_totals_send_one_row_per_line(spark):
    """Three articles, two families and two statuses of one order: six rows were sent for each line folded by kind."""
    lines = [(1, i, f"a{i % 3}", f"f{i % 2}", 1.0, 0.5, "ok" if i % 4 else None, at(f"2025-01-{28 - i % 6:02d}")) for i in range(12)]
    parts = spark.createDataFrame(
        lines,
        "id_ot long, id_demande long, article string, famille string, quantite_demande double, cout_total double, etat string, date_demande timestamp",
    )
    totals = ig.part_totals(parts)
    plan = totals._jdf.queryExecution().sparkPlan().toString()
    assert "explode" not in plan and plan.index("inline(") < plan.index("Exchange")  # printed from the last step to the first
    row = totals.first()
    assert (row["num_spare_parts_requests"], row["total_parts_quantity"], row["total_parts_cost"]) == (12, 12.0, 6.0)
    assert (row["parts_articles"], row["parts_families"], row["parts_request_status"]) == ("a2, a1, a0", "f1, f0", "ok")
