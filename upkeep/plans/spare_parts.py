"""Spare-part reports: Pareto, consumption, demand forecast, reorder points, stock health."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expressions import none_null, percent, present, safe_ratio, whole_days_between
from ..operators.frequency import top_counts, value_counts
from ..operators.lookups import with_summary
from ..operators.ordered import running_totals
from ..operators.slicing import DEFAULT_POLICY, SlicePolicy
from ..session import materialize
from ..sources.readers import read_table
from ..sources.writers import write_summary, write_table

ARTICLE, FAMILY = "article", "famille"
REQUEST_ORDER = ("date_demande", "id_demande")
LEAD_TIME_DAYS = 7
SAFETY_FACTOR = 1.5
PARETO_SHARE = 80.0


def article_state(parts: DataFrame, order: Sequence[str] = REQUEST_ORDER) -> DataFrame:
    """One row per article (also the missing one) from which Pareto, forecast, reorder points and health are finished.

    Whoever finishes only some of them reads and aggregates only what these need; Catalyst prunes the rest, and what
    ``parts`` has no columns for is left out.
    """
    aggregates = {
        "_rows": (F.count(F.lit(1)), ()),
        "_requests": (F.count("id_demande"), ("id_demande",)),
        "_cost": (F.sum("cout_total"), ("cout_total",)),
        "_quantity": (F.sum("quantite_demande"), ("quantite_demande",)),
        "_mean_quantity": (F.avg("quantite_demande"), ("quantite_demande",)),
        "_std_quantity": (F.stddev_samp("quantite_demande"), ("quantite_demande",)),
        FAMILY: (F.min_by(FAMILY, _at(parts, order, FAMILY)), (FAMILY,)),
        "_stock": (F.max_by("quantite_dispo", _at(parts, order, "quantite_dispo")), ("quantite_dispo",)),
        "_first_date": (F.min("date_demande"), ("date_demande",)),
        "_last_date": (F.max("date_demande"), ("date_demande",)),
        "_short": (F.count_if(_is_short()), ("quantite_dispo", "quantite_demande")),
        "_rejected": (F.count_if(_is_rejected()), ("etat",)),
    }
    usable = {name: fold for name, (fold, needs) in aggregates.items() if set(needs) <= set(parts.columns)}
    return parts.groupBy(ARTICLE).agg(*[fold.alias(name) for name, fold in usable.items()])


def _articles(state: DataFrame) -> DataFrame:
    return state.where(none_null([ARTICLE]))


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0.0))


def pareto_analysis(parts: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Per article: cost, quantity, requests, running cost and cumulative percent, dearest first.

    The running total works on one row per article and splits into slices when there are many articles.
    """
    return _pareto(article_state(parts), policy)


def _pareto(state: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    per_article = _articles(state).select(
        ARTICLE,
        _zero("_cost").alias("total_cost"),
        _zero("_quantity").alias("total_quantity"),
        F.col("_requests").alias("request_count"),
    )
    ranked = running_totals(
        per_article.withColumn("_rank", -F.col("total_cost")),
        [],
        ["_rank", ARTICLE],
        {"cumulative_cost": "total_cost"},
        {"_all_cost": "total_cost"},
        policy,
    )
    return ranked.withColumn("cumulative_pct", percent("cumulative_cost", "_all_cost")).drop("_rank", "_all_cost")


def pareto_set(pareto: DataFrame, share: float = PARETO_SHARE) -> DataFrame:
    """Articles up to the cumulative share; the one that crosses it is left out."""
    return pareto.where(F.col("cumulative_pct") <= share)


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0.0))


def consumption_by_family(parts: DataFrame) -> DataFrame:
    return (
        parts.where(none_null([FAMILY]))
        .groupBy(FAMILY)
        .agg(
            _sum("cout_total").alias("total_cost"),
            F.avg("cout_total").alias("avg_cost"),
            F.count("cout_total").alias("cost_count"),
            _sum("quantite_demande").alias("total_quantity"),
        )
        .orderBy(F.col("total_cost").desc(), FAMILY)
    )


def _observed_days(rows: DataFrame, first: str = "date_demande", last: str = "date_demande") -> DataFrame:
    """Whole days between first and last request of the table, at least 1."""
    days = whole_days_between(F.min(first), F.max(last))
    return rows.agg(F.greatest(F.coalesce(days, F.lit(1)), F.lit(1)).alias("_days"))


def _at(parts: DataFrame, order: Sequence[str], value: str) -> Column:
    """Order position of a row, unknown where the value is missing (so first / last skip nulls)."""
    fields = [f for name in present(parts, order) for f in (F.col(name).isNull(), F.col(name))]
    return F.when(F.col(value).isNotNull(), F.struct(*fields))


def demand_forecast(
    parts: DataFrame, forecast_days: int = 90, order: Sequence[str] = REQUEST_ORDER
) -> DataFrame:
    """Per article: observed daily rate extended over ``forecast_days``, priced at its mean unit cost."""
    return _forecast(article_state(parts, order), _observed_days(parts), forecast_days)


def _forecast(state: DataFrame, observed: DataFrame, forecast_days: int) -> DataFrame:
    per_article = _articles(state).select(
        ARTICLE,
        _zero("_quantity").alias("total_qty"),
        _zero("_cost").alias("total_cost"),
        F.col("_requests").alias("n_requests"),
        FAMILY,
    )
    forecast = with_summary(per_article, observed).withColumns({"daily_demand": F.col("total_qty") / F.col("_days")})
    return (
        forecast.withColumn("forecast_qty", F.col("daily_demand") * forecast_days)
        .withColumn(
            "forecast_cost",
            F.coalesce(safe_ratio("total_cost", "total_qty") * F.col("forecast_qty"), F.lit(0.0)),
        )
        .drop("_days")
        .orderBy(F.col("forecast_cost").desc(), ARTICLE)
    )


def reorder_analysis(
    parts: DataFrame, safety_factor: float = SAFETY_FACTOR, order: Sequence[str] = REQUEST_ORDER
) -> DataFrame:
    """Per article: demand statistics, latest stock, reorder point, reorder flag and suggested quantity.

    First family and last stock follow the request order, and the suggestion rounds half to even.
    """
    return _reorder(article_state(parts, order), _observed_days(parts), safety_factor)


def _reorder(state: DataFrame, observed: DataFrame, safety_factor: float) -> DataFrame:
    per_article = _articles(state).select(
        ARTICLE,
        _zero("_quantity").alias("total_demand"),
        F.col("_mean_quantity").alias("avg_demand_per_request"),
        _zero("_std_quantity").alias("demand_std"),
        F.col("_stock").alias("current_stock"),
        FAMILY,
        _zero("_cost").alias("total_cost"),
    )
    point = F.col("daily_demand") * LEAD_TIME_DAYS + F.lit(safety_factor) * F.col("demand_std")
    missing = F.col("reorder_point") * 2 - F.col("current_stock")
    return (
        with_summary(per_article, observed)
        .withColumn("daily_demand", F.col("total_demand") / F.col("_days"))
        .withColumn("reorder_point", point)
        .withColumn("needs_reorder", F.coalesce(F.col("current_stock") < F.col("reorder_point"), F.lit(False)))
        .withColumn(
            "suggested_order_qty",
            F.when(missing.isNotNull(), F.bround(F.greatest(missing, F.lit(0.0)), 0)),
        )
        .drop("_days")
        .orderBy(F.col("needs_reorder").desc(), ARTICLE)
    )


def stock_out_cost_by_family(parts: DataFrame) -> DataFrame:
    """Cost and number of the requests that met an empty stock, per family, dearest first."""
    return (
        parts.where((F.col("quantite_dispo") == 0) & none_null([FAMILY]))
        .groupBy(FAMILY)
        .agg(_sum("cout_total").alias("stockout_cost"), F.count("cout_total").alias("requests"))
        .orderBy(F.col("stockout_cost").desc(), FAMILY)
    )


def stock_out_overview(parts: DataFrame) -> DataFrame:
    """One row: requests on empty stock, their share and their cost."""
    empty = F.col("quantite_dispo") == 0
    return parts.agg(
        F.count_if(empty).alias("stockout_requests"),
        F.coalesce(percent(F.count_if(empty), F.count(F.lit(1))), F.lit(0.0)).alias("stockout_pct"),
        F.coalesce(F.sum(F.when(empty, F.col("cout_total"))), F.lit(0.0)).alias("stockout_cost"),
    )


def _is_short() -> Column:
    return F.col("quantite_dispo") < F.col("quantite_demande")


def _is_rejected() -> Column:
    return F.col("etat") == "rejet"


def _short(parts: DataFrame) -> DataFrame:
    return parts.where(_is_short())


def top_stock_out_families(parts: DataFrame, limit: int | None = 5) -> DataFrame:
    """Families with most requests beyond the available stock."""
    return top_counts(_short(parts), FAMILY, limit)


def stock_health_summary(parts: DataFrame) -> DataFrame:
    """One row: requests, articles, stock-outs, rejections, cost, and the five worst families as a map."""
    return _health(article_state(parts), parts)


def _health(state: DataFrame, parts: DataFrame) -> DataFrame:
    rows, short, rejected = F.sum("_rows"), F.coalesce(F.sum("_short"), F.lit(0)), F.coalesce(F.sum("_rejected"), F.lit(0))
    summary = state.agg(
        F.coalesce(rows, F.lit(0)).alias("total_requests"),
        F.count(ARTICLE).alias("unique_articles"),
        short.alias("stock_out_count"),
        F.round(percent(short, rows), 1).alias("stock_out_pct"),
        rejected.alias("rejection_count"),
        F.round(percent(rejected, rows), 1).alias("rejection_rate_pct"),
        _sum("_cost").alias("total_cost"),
    )
    worst = top_stock_out_families(parts).agg(
        F.map_from_entries(
            F.transform(
                F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("rank"), F.col(FAMILY)))),
                lambda item: F.struct(item[FAMILY], -item["rank"]),
            )
        ).alias("top_stockout_families")
    )
    return with_summary(summary, worst)


def stock_by_family(parts: DataFrame) -> DataFrame:
    """Mean available stock per family, largest first."""
    return (
        parts.where(none_null([FAMILY]))
        .groupBy(FAMILY)
        .agg(F.avg("quantite_dispo").alias("avg_stock"))
        .orderBy(F.col("avg_stock").desc_nulls_last(), FAMILY)
    )


def rejection_reasons(parts: DataFrame, limit: int | None = 10) -> DataFrame:
    return top_counts(parts.where(F.col("etat") == "rejet"), "motif_rejet", limit)


def rejections_by_family(parts: DataFrame) -> DataFrame:
    return value_counts(parts.where(F.col("etat") == "rejet"), FAMILY).orderBy(F.col("count").desc(), FAMILY)


def cost_by_family(parts: DataFrame, limit: int = 10) -> DataFrame:
    """Dearest families."""
    return consumption_by_family(parts).select(FAMILY, "total_cost").limit(limit)


def spare_parts_summary(parts: DataFrame, order: Sequence[str] = REQUEST_ORDER) -> DataFrame:
    """One row: stock health, size of the Pareto set, articles to reorder, 90-day forecast cost.

    The requests are read twice: for the stored row per article, from which all parts finish, and for the worst families.
    """
    state = materialize(article_state(parts, order))
    observed = _observed_days(state, "_first_date", "_last_date")
    pareto = _pareto(state).agg(
        F.count_if(F.col("cumulative_pct") <= PARETO_SHARE).alias("pareto_80_count"),
        F.count(F.lit(1)).alias("pareto_total_articles"),
    )
    reorder = _reorder(state, observed, SAFETY_FACTOR).agg(F.count_if("needs_reorder").alias("articles_needing_reorder"))
    forecast = _forecast(state, observed, 90).agg(_sum("forecast_cost").alias("total_forecast_cost_90d"))
    summary = _health(state, parts)
    for block in (pareto, reorder, forecast):
        summary = with_summary(summary, block)
    return summary


def run_spare_parts(spark: SparkSession, processed_folder: str, reports_folder: str) -> Mapping[str, str]:
    """Write Pareto, forecast, reorder tables and the JSON summary; returns the paths."""
    parts = read_table(spark, processed_folder, "spare_parts_cleaned", ("date_demande",))
    tables = {
        "pareto_analysis": pareto_analysis(parts),
        "demand_forecast": demand_forecast(parts),
        "reorder_analysis": reorder_analysis(parts),
    }
    paths = {name: write_table(df, reports_folder, name, csv=True) for name, df in tables.items()}
    paths["spare_parts_summary"] = write_summary(spare_parts_summary(parts), reports_folder, "spare_parts_summary")
    return paths
