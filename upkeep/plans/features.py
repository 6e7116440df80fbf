"""Feature table of the repair orders.

Layout at scale: the low-cardinality statistics (family, site, zone, provider) come from one grouping-sets scan
and are attached by size-checked joins; everything per asset shares a single exchange on ``(asset, slice)`` -
the lag/lead/rolling windows use it directly, and the per-asset aggregates join on the same key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expressions import days_between, flag_name, guarded_ratio, indicator, none_null, present, quoted
from ..operators.lookups import Lookup, attach_codes, category_codes, key_statistics, with_summary
from ..operators.ordered import add_row_windows, running_totals, with_row_windows
from ..operators.quantiles import exact_quantiles
from ..operators.slicing import DEFAULT_POLICY, HOT, SLICE, SlicePlan, SlicePolicy, plan_slices
from ..session import materialize, store
from ..sources.readers import read_table
from ..sources.writers import feature_metadata, write_summary, write_table

ASSET, CREATED, ORDER_ID = "id_actif", "date_creation_ot", "id_ordre_travail"
TIME_ORDER = (CREATED, ORDER_ID)
TOP_ANOMALIES = 20
# The urgency levels of the export, each a column of the feature table.
URGENCIES = ("Faible", "Fort", "Moyen")

# Encoded text columns, targets and the columns that never reach the feature table.
ENCODED_COLUMNS = ("portfolio", "site", "zone", "famille", "groupe", "prestataire", "etat")
TARGET_COLUMNS = (
    "will_fail_within_30_days", "anomaly_type_encoded", "spare_parts_cost_target", "intervention_duration_target",
    "will_need_spare_parts",
)
DROPPED_COLUMNS = (
    "date_declaration", "date_creation_ot", "date_debut_reparation", "date_cloture", "date_reouverture",
    "date_validation", "date_rejet", "commentaire_cloture", "commentaire_ouverture", "description", "motif_rejet",
    "motif_standby", "responsable_cloture", "responsable_reouverture", "responsable_rejet", "validateur_travaux",
    "createur_ot", "demandeur", "utilisateur_prestataire", "time_since_last_failure", "first_maintenance_date",
    "next_failure_date", "parts_articles", "actif", "localisation", "anomalie", "plateforme_creation",
    "plateforme_prestataire", "plateforme_cloture", "plateforme_rejet", "plateforme_reouverture",
    "plateforme_validation",
)

ROLLING_ROWS = {"7d": 7, "30d": 30}


# --- calendar and elapsed time ------------------------------------------------------------------------------

def calendar_columns(df: DataFrame) -> DataFrame:
    """Hour, weekday (Monday 0), day, month, quarter, weekend and business-hours flags."""
    hour, weekday = F.hour(CREATED), F.weekday(CREATED)
    return df.withColumns(
        {
            "creation_hour": hour.cast("long"),
            "creation_day_of_week": weekday.cast("long"),
            "creation_day_of_month": F.dayofmonth(CREATED).cast("long"),
            "creation_month": F.month(CREATED).cast("long"),
            "creation_quarter": F.quarter(CREATED).cast("long"),
            "creation_is_weekend": indicator(weekday.isin(5, 6)),
            "creation_is_business_hours": indicator((hour >= 8) & (hour < 18)),
        }
    )


def days_since_previous(
    df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY, plan: SlicePlan | None = None
) -> DataFrame:
    """Add the days since the asset's previous order; the base of MTBF and of the elapsed-time feature."""
    outputs = {"days_since_previous": _days_since_previous}
    return with_row_windows(df, [ASSET], TIME_ORDER, outputs, [], before=1, policy=policy, plan=plan)


def _days_since_previous(spec) -> Column:
    return days_between(F.lag(CREATED).over(spec), F.col(CREATED))


def _fill_with_median(df: DataFrame, name: str, policy: SlicePolicy) -> DataFrame:
    """Stores the rows once, so that their windows are not run again for the median."""
    df = materialize(df)
    return _filled(df, name, exact_quantiles(df, [], name, {"_median": 0.5}, policy=policy))


def _filled(df: DataFrame, name: str, median: DataFrame) -> DataFrame:
    return with_summary(df, median).withColumn(name, F.coalesce(name, "_median")).drop("_median")


def _median_since(df: DataFrame, plan: SlicePlan, policy: SlicePolicy) -> DataFrame:
    """Median of the days since the asset's previous order, from a pass over keys and times that stores one column."""
    name = "days_since_previous"
    lagged, _ = store(days_since_previous(df.select(ASSET, *TIME_ORDER), plan=plan).select(name))
    return exact_quantiles(lagged, [], name, {"_median": 0.5}, policy=policy)


def time_features(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Calendar columns and days since the asset's previous order, first orders filled with the overall median."""
    name = "days_since_last_maintenance"
    plan = plan_slices(df, [ASSET], TIME_ORDER, policy)
    lagged = days_since_previous(calendar_columns(df), plan=plan).withColumnRenamed("days_since_previous", name)
    return _fill_with_median(lagged, name, policy)


# --- per-key statistics ---------------------------------------------------------------------------------------

def _asset_statistics(df: DataFrame) -> DataFrame:
    return df.where(none_null([ASSET])).groupBy(ASSET).agg(
        F.count(F.lit(1)).alias("equipment_failure_count"),
        F.avg("cout_total").alias("equipment_avg_cost"),
        F.avg("duree_intervention_par_heure").alias("equipment_avg_duration"),
        F.min(CREATED).alias("first_maintenance_date"),
    )


def _asset_recurrence(df: DataFrame) -> DataFrame:
    """Largest count of one anomaly type per asset; two map-side combined levels."""
    per_type = df.where(none_null([ASSET, "anomalie"])).groupBy(ASSET, "anomalie").agg(F.count(F.lit(1)).alias("_n"))
    return per_type.groupBy(ASSET).agg(F.max("_n").alias("anomaly_recurrence_count"))


def _with_age(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "equipment_age_days", F.coalesce(days_between("first_maintenance_date", CREATED), F.lit(0.0))
    )


def _join_per_asset(df: DataFrame, base: DataFrame, statistics: DataFrame, policy: SlicePolicy) -> DataFrame:
    """Attach one-row-per-asset statistics by the salted join, safe for an asset with a large share of the rows."""
    sliced = plan_slices(base, [ASSET], TIME_ORDER, policy).apply(df)
    return sliced.join_statistics(sliced.rows, statistics).drop(SLICE, HOT)


# Which aggregate each lookup column needs, by key.
_LOOKUP_COLUMNS: dict[tuple[str, ...], dict[str, str]] = {
    ("famille",): {
        "famille_failure_count": "orders",
        "famille_avg_cost": "avg_cost",
        "famille_spare_parts_usage_rate": "parts_rate",
        "famille_high_urgency_rate": "urgent_rate",
    },
    ("site",): {"site_failure_count": "orders", "site_avg_cost": "avg_cost"},
    ("site", "zone"): {"zone_failure_count": "orders"},
    ("prestataire",): {
        "provider_avg_time_to_closure": "avg_closure",
        "provider_avg_cost": "avg_cost",
        "provider_work_volume": "orders",
    },
}


def _lookup_aggregates(df: DataFrame) -> dict[str, Column]:
    aggregates = {"orders": F.count(F.lit(1))}
    for output, source, build in (
        ("avg_cost", "cout_total", F.avg),
        ("avg_closure", "time_to_closure_hours", F.avg),
        ("parts_rate", "num_spare_parts_requests", lambda n: F.avg(indicator(F.col(n) > 0))),
        ("urgent_rate", "urgence", lambda n: F.avg(indicator(F.col(n) == "Fort"))),
    ):
        if source in df.columns:
            aggregates[output] = build(source)
    return aggregates


@dataclass(frozen=True)
class FeatureStatistics:
    """Small tables learnt from the orders: per-key statistics, top anomaly types, codes."""

    lookups: dict[tuple[str, ...], Lookup]
    anomalies: tuple[str, ...] = ()
    codes: dict[str, Lookup] = field(default_factory=dict)

    def attach(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        for keys, columns in _LOOKUP_COLUMNS.items():
            chosen = {out: source for out, source in columns.items() if out in names}
            if chosen:
                df = self.lookups[keys].keep(**chosen).attach(df)
        return df


def _statistics_for(df: DataFrame, names: Sequence[str]) -> FeatureStatistics:
    needed = {keys: {c[n] for n in c if n in names} for keys, c in _LOOKUP_COLUMNS.items()}
    needed = {keys: sources for keys, sources in needed.items() if sources}
    wanted = set().union(*needed.values())
    aggregates = {name: agg for name, agg in _lookup_aggregates(df).items() if name in wanted}
    return FeatureStatistics(key_statistics(df, list(needed), aggregates))


def fit_statistics(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> FeatureStatistics:
    """Learn every lookup of the feature table in one scan, plus the category codes in a second."""
    key_sets = [*_LOOKUP_COLUMNS, ("anomalie",)]
    lookups = key_statistics(df, key_sets, _lookup_aggregates(df))
    return FeatureStatistics(
        {keys: lookups[keys] for keys in _LOOKUP_COLUMNS},
        _top_anomalies(lookups[("anomalie",)].table, "orders"),
        category_codes(df, [*present(df, ENCODED_COLUMNS), "anomalie"], policy),
    )


# --- one operator per feature family ----------------------------------------------------------------------------

def equipment_features(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Per asset: failures, mean cost, mean duration, age; per family: failures, mean cost."""
    names = ("famille_failure_count", "famille_avg_cost")
    enriched = _statistics_for(df, names).attach(df, names)
    return _with_age(_join_per_asset(enriched, df, _asset_statistics(df), policy))


def location_features(df: DataFrame) -> DataFrame:
    names = ("site_failure_count", "site_avg_cost", "zone_failure_count")
    return _statistics_for(df, names).attach(df, names)


def _parts_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "has_spare_parts": indicator(F.col("num_spare_parts_requests") > 0),
            "spare_parts_cost_ratio": guarded_ratio("total_parts_cost", "cout_total"),
        }
    )


def spare_parts_features(df: DataFrame) -> DataFrame:
    """Parts flag, parts share of the cost (0 for free orders) and the family's usage rate."""
    names = ("famille_spare_parts_usage_rate",)
    return _statistics_for(df, names).attach(_parts_columns(df), names)


def _top_anomalies(counts: DataFrame, count: str) -> tuple[str, ...]:
    top = counts.orderBy(F.col(count).desc(), "anomalie").limit(TOP_ANOMALIES)
    return tuple(row["anomalie"] for row in top.collect())


def _anomaly_flags(df: DataFrame, anomalies: Sequence[str]) -> DataFrame:
    """0/1 column per frequent type; types whose shortened names collide share one column."""
    flags: dict[str, Column] = {}
    for label in anomalies:
        name = flag_name("anomaly", label)
        matches = indicator(F.col("anomalie") == label)
        flags[name] = F.greatest(flags[name], matches) if name in flags else matches
    return df.withColumns(flags) if flags else df


def flag_columns(df: DataFrame) -> list[str]:
    """The columns of frequent anomaly types, whose names come from the data."""
    return [n for n in df.columns if n.startswith("anomaly_") and n not in ("anomaly_recurrence_count", "anomaly_type_encoded")]


def anomaly_features(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Flags of the 20 most frequent anomaly types (ties by name) and the asset's strongest recurrence."""
    counts = df.where(F.col("anomalie").isNotNull()).groupBy("anomalie").agg(F.count(F.lit(1)).alias("orders"))
    flagged = _anomaly_flags(df, _top_anomalies(counts, "orders"))
    return _join_per_asset(flagged, df, _asset_recurrence(df), policy)


def flag_rows(df: DataFrame, name: str, identity: str = "id_ordre_travail", prefix: str | None = None) -> DataFrame:
    """One-hot encoding as sparse rows (order, flag, value): one row for the level an order has, whatever the number of levels."""
    flag = F.concat(F.lit(f"{prefix or name}_"), F.col(name))
    return df.where(F.col(name).isNotNull()).select(identity, flag.alias("flag"), F.lit(1).alias("value"))


def anomaly_flag_rows(df: DataFrame, identity: str = "id_ordre_travail") -> DataFrame:
    """The set flags of the 20 most frequent anomaly types as sparse rows; shortened names that collide are one flag."""
    counts = df.where(F.col("anomalie").isNotNull()).groupBy("anomalie").agg(F.count(F.lit(1)).alias("orders"))
    names = {label: flag_name("anomaly", label) for label in _top_anomalies(counts, "orders")}
    flag = F.coalesce(*[F.when(F.col("anomalie") == label, F.lit(name)) for label, name in names.items()], F.lit(None))
    return df.select(identity, flag.alias("flag"), F.lit(1).alias("value")).where(F.col("flag").isNotNull())


def _urgency_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({f"urgence_{level}": F.coalesce(F.col("urgence") == level, F.lit(False)) for level in URGENCIES})


def urgency_features(df: DataFrame) -> DataFrame:
    """Boolean column per known urgency level and the family's share of ``Fort``; ``flag_rows`` has any level."""
    names = ("famille_high_urgency_rate",)
    return _statistics_for(df, names).attach(_urgency_flags(df), names)


def provider_features(df: DataFrame) -> DataFrame:
    names = ("provider_avg_time_to_closure", "provider_avg_cost", "provider_work_volume")
    return _statistics_for(df, names).attach(df, names)


def _rolling_windows() -> dict:
    outputs = {}
    for label, size in ROLLING_ROWS.items():
        outputs[f"rolling_{label}_failures"] = lambda w, n=size: F.count(ORDER_ID).over(w.rowsBetween(1 - n, 0))
        outputs[f"rolling_{label}_avg_cost"] = lambda w, n=size: F.avg("cout_total").over(w.rowsBetween(1 - n, 0))
    return outputs


def rolling_features(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Order count and mean cost over the asset's last 7 / 30 orders (rows, as the names do not say)."""
    before = max(ROLLING_ROWS.values()) - 1
    return with_row_windows(df, [ASSET], TIME_ORDER, _rolling_windows(), ["cout_total"], before, policy=policy)


def rolling_features_time(
    df: DataFrame, days: Sequence[int] = (7, 30), policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Order count and mean cost over true windows of ``days`` days ending at each order (both ends included).

    Each order enters a window at its time and leaves ``days`` later, so the window content is a running total
    of entries minus exits.  This stays linear where a RANGE frame rescans its content for every row.
    Costs are summed as decimals, because exits must cancel entries exactly.
    """
    amount = F.col("cout_total").cast("decimal(28,8)")
    base = df.where(F.col(CREATED).isNotNull()).select(ASSET, ORDER_ID, CREATED, amount.alias("_amount"))
    counted = F.when(F.col("_amount").isNotNull(), F.lit(1)).otherwise(F.lit(0))

    def entry(moment: Column, rank: int, sign: int, active: int | None) -> Column:
        parts = []
        for length in days:
            applies = active is None or active == length
            unit = F.lit(sign if applies else 0)
            parts += [
                unit.cast("long").alias(f"_n{length}"),
                (unit * counted).cast("long").alias(f"_c{length}"),
                (unit * F.coalesce("_amount", F.lit(0).cast("decimal(28,8)"))).cast("decimal(28,8)").alias(f"_s{length}"),
            ]
        return F.struct(moment.alias("_at"), F.lit(rank).alias("_rank"), *parts)

    leave = lambda length: F.col(CREATED) + F.make_dt_interval(days=F.lit(length))
    entries = [
        entry(F.col(CREATED), 0, 1, None),
        entry(F.col(CREATED), 1, 0, None),
        *[entry(leave(length), 2, -1, length) for length in days],
    ]
    moves = base.select(ASSET, ORDER_ID, CREATED, F.inline(F.array(*entries)))
    moves = moves.where(none_null([ASSET]))
    sums = {f"{kind}{length}": f"_{kind}{length}" for length in days for kind in "ncs"}
    running = running_totals(moves, [ASSET], ["_at", "_rank", ORDER_ID], sums, policy=policy)
    outputs = []
    for length in days:
        mean = F.try_divide(F.col(f"s{length}").cast("double"), F.col(f"c{length}").cast("double"))
        outputs += [
            F.col(f"n{length}").alias(f"last_{length}_days_failures"),
            mean.alias(f"last_{length}_days_avg_cost"),
        ]
    return running.where(F.col("_rank") == 1).select(ORDER_ID, ASSET, CREATED, *outputs)


def encode_categoricals(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """``<name>_encoded``: rank of the text among all values in code-point order, missing = ``nan``."""
    names = present(df, ENCODED_COLUMNS)
    return attach_codes(df, category_codes(df, names, policy), {name: f"{name}_encoded" for name in names})


def _next_failure(spec) -> Column:
    return F.lead(CREATED).over(spec)


def _target_columns(df: DataFrame) -> DataFrame:
    to_next = days_between(CREATED, "next_failure_date")
    return df.withColumns(
        {
            "days_to_next_failure": to_next,
            "will_fail_within_30_days": indicator(to_next <= 30),
            "spare_parts_cost_target": F.col("total_parts_cost"),
            "intervention_duration_target": F.col("duree_intervention_par_heure"),
            "will_need_spare_parts": F.col("has_spare_parts"),
        }
    )


def create_targets(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Next failure (time, days, within 30 days), anomaly code, parts cost, duration and parts need.

    Expects ``has_spare_parts`` from :func:`spare_parts_features`.
    """
    led = with_row_windows(
        df, [ASSET], TIME_ORDER, {"next_failure_date": _next_failure}, [], after=1, policy=policy
    )
    coded = attach_codes(led, category_codes(df, ["anomalie"], policy), {"anomalie": "anomaly_type_encoded"})
    return _target_columns(coded)


# --- the whole table ------------------------------------------------------------------------------------------

def all_features(
    df: DataFrame, statistics: FeatureStatistics | None = None, policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Every feature and target, before columns are dropped.

    The wide rows are not stored: a caller that reads them more than once stores the columns it needs.
    """
    statistics = statistics or fit_statistics(df, policy)
    rows = statistics.attach(df, [name for columns in _LOOKUP_COLUMNS.values() for name in columns])
    encoded = {name: f"{name}_encoded" for name in present(df, ENCODED_COLUMNS)}
    rows = attach_codes(rows, statistics.codes, {**encoded, "anomalie": "anomaly_type_encoded"})
    attached = [name for name in rows.columns if name not in df.columns]
    codes = [name for name in attached if name in (*encoded.values(), "anomaly_type_encoded")]

    plan = plan_slices(df, [ASSET], TIME_ORDER, policy)
    sliced = plan.apply(rows)
    since = "days_since_last_maintenance"
    windows = {since: _days_since_previous, "next_failure_date": _next_failure, **_rolling_windows()}
    rows = add_row_windows(sliced, windows, ["cout_total"], max(ROLLING_ROWS.values()) - 1, 1)
    per_asset = _asset_statistics(df).join(_asset_recurrence(df), ASSET, "left")
    rows = sliced.join_statistics(rows, per_asset).drop(SLICE, HOT)

    # What follows from the row alone comes last, so that its forty columns are neither shuffled nor sorted for the windows.
    own = [name for name in rows.columns if name in df.columns]
    late = [name for name in rows.columns if name not in own and name not in attached]
    calendar = _parts_columns(calendar_columns(rows))
    flags = _urgency_flags(_anomaly_flags(calendar, statistics.anomalies))
    added = lambda after, before: [name for name in after.columns if name not in before.columns]
    lookups = [name for name in attached if name not in codes]
    rows = flags.select(*map(quoted, [*own, *added(calendar, rows), *lookups, *added(flags, calendar), *codes, *late]))
    return _target_columns(_filled(_with_age(rows), since, _median_since(df, plan, policy)))


def feature_table(
    df: DataFrame, statistics: FeatureStatistics | None = None, policy: SlicePolicy = DEFAULT_POLICY
) -> DataFrame:
    """Model-ready features of integrated repair orders (with part totals attached)."""
    rows = all_features(df, statistics, policy)
    return rows.drop(*present(rows, DROPPED_COLUMNS))


def run_features(spark: SparkSession, processed_folder: str, features_folder: str, csv: bool = False) -> DataFrame:
    """Processed orders -> feature table, category codes and metadata in ``features_folder``."""
    times = ("date_creation_ot", "date_cloture", "date_declaration", "date_debut_reparation")
    orders = read_table(spark, processed_folder, "corrective_integrated", times)
    statistics = fit_statistics(orders)
    path = write_table(feature_table(orders, statistics), features_folder, "corrective_features", csv)
    stored = spark.read.parquet(path)
    codes = None
    for name, lookup in statistics.codes.items():
        part = lookup.table.select(F.lit(name).alias("column"), F.col(name).alias("value"), "code")
        codes = part if codes is None else codes.unionByName(part)
    write_table(codes, features_folder, "label_codes")
    write_summary(feature_metadata(stored, list(TARGET_COLUMNS)), features_folder, "feature_metadata")
    return stored


FEATURE_GROUPS = {
    # Name fragments that place a numeric feature in a group (a feature may belong to several).
    "Temporelles": ("creation_", "days_since"),
    "Equipement": ("equipment_", "famille_"),
    "Localisation": ("site_", "zone_"),
    "Pieces rechange": ("spare", "parts"),
    "Prestataire": ("provider_",),
    "Fenetres glissantes": ("rolling_",),
    "Encodees": ("_encoded",),
}


def feature_groups(features: DataFrame) -> DataFrame:
    """(group, numeric features whose name carries a fragment of it, their non-null values), counted in one pass."""
    numeric = [f.name for f in features.schema.fields if f.dataType.typeName() in ("long", "integer", "double", "float")]
    members = {g: [n for n in numeric if any(part in n for part in parts)] for g, parts in FEATURE_GROUPS.items()}
    counts = features.agg(*[F.count(quoted(n)).alias(n) for n in dict.fromkeys(sum(members.values(), []))])
    groups = [
        F.struct(
            F.lit(group).alias("feature_group"),
            F.lit(len(names)).cast("long").alias("features"),
            sum((quoted(n) for n in names), F.lit(0).cast("long")).alias("known_values"),
        )
        for group, names in members.items()
    ]
    return counts.select(F.inline(F.array(*groups)))
