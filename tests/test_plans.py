"""Physical plans stay free of cross joins and Python, prune columns and share one exchange."""

import pytest

from upkeep import catalog
from upkeep.operators.slicing import SlicePolicy
from upkeep.plans import effectiveness as eff, features as ft, integration, spare_parts
from upkeep.sources import star_tables as star

SF = "/root/testdata/sf0.001"
RELATIONAL = "maintenance_intervals rolling_features pareto_analysis time_features effectiveness_labels asset_master mtbf_by_family".split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups"):
        assert word not in plan


def test_windows_of_one_asset_share_an_exchange(spark):
    orders = catalog.repairs(spark, SF, "id_ordre_travail id_actif date_creation_ot cout_total")
    plan = plan_of(ft.rolling_features(orders))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_as_of_reads_only_its_columns_and_has_a_linear_frame(spark):
    orders = catalog.repairs(spark, SF, catalog.BASE)
    plan = plan_of(eff.maintenance_intervals(orders, catalog.planned(spark, SF, catalog.INTERVAL_PLANNED)))
    assert "o_totalprice" not in plan and "o_comment" not in plan
    assert "unboundedfollowing" not in plan.split("min(_candidate")[1].split("_local")[0]
    assert "In(o_orderstatus, [O,P])" in plan


def test_sliced_plan_has_no_cross_join_either(spark):
    orders = catalog.repairs(spark, SF, "id_ordre_travail id_actif date_creation_ot cout_total")
    plan = plan_of(ft.rolling_features(orders, SlicePolicy(rows_per_slice=10)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_part_totals_scan_the_requests_once(spark):
    orders = catalog.repairs(spark, SF, "id_ordre_travail")
    plan = plan_of(integration.attach_parts(orders, star.spare_parts(spark, SF), star.PART_ORDER))
    assert plan.count("lineitem.parquet") == 1
    totals = plan_of(integration.part_totals(star.spare_parts(spark, SF, [c for c in star.SPARE_PARTS_COLUMNS if c not in ("quantite_dispo",)]), star.PART_ORDER))
    assert totals.count("Exchange hashpartitioning(id_ot") == 2 and totals.count("lineitem.parquet") == 1


def test_spare_parts_summary_reads_the_requests_twice(spark):
    started = []
    whole = star.spare_parts(spark, SF)
    parts = whole.select("*")
    summary = spare_parts.spare_parts_summary(parts, star.PART_ORDER)
    started.append(plan_of(summary).count("lineitem.parquet"))
    assert started == [1]  # the worst families; the row per article is stored


def test_reports_from_the_article_state_prune_what_they_do_not_need(spark):
    plan = plan_of(spare_parts.pareto_analysis(star.spare_parts(spark, SF)))
    assert "l_shipdate" not in plan and "l_returnflag" not in plan
