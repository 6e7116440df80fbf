"""Cleaning of the three raw tables: narrow projections, one code-generated stage each.

Every step is skipped when its columns are absent, so partial exports can be cleaned too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.expressions import (
    ORDER_TIME_FORMAT,
    REQUEST_TIME_FORMAT,
    days_between,
    guarded_ratio,
    hours_between,
    parse_flag,
    parse_mixed_time,
    parse_time,
    present,
)

# Column names and the damaged status spelling of the exports.
CORRECTIVE_TIMES = (
    "date_declaration", "date_creation_ot", "date_debut_reparation", "date_cloture", "date_reouverture",
    "date_validation", "date_rejet",
)
CORRECTIVE_FLAGS = ("vandalisme", "palliative", "avec_demande_pdr", "est_reouvert")
CORRECTIVE_COSTS = ("cout_maindoeuvre", "cout_pdr", "cout_bc", "cout_total")
PREVENTIVE_TIMES = (
    "date_debut_planifiee", "date_fin_planifiee", "date_debut", "date_fin", "date_cloture", "date_validation",
)
REQUEST_TIMES = ("date_demande", "date_validation_superviseur", "date_cloture", "date_rejet")
DAMAGED_STATUS, REPAIRED_STATUS = "Clotur\ufffd", "Cloture"


def _convert(df: DataFrame, names: Sequence[str], change: Callable[[str], Column]) -> DataFrame:
    found = present(df, names)
    return df.withColumns({name: change(name) for name in found}) if found else df


def _text_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in present(df, names) if isinstance(df.schema[n].dataType, T.StringType)]


def _zero_fill(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return _convert(df, names, lambda name: F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0)))


def _derive(df: DataFrame, name: str, needs: Sequence[str], build: Callable[..., Column]) -> DataFrame:
    return df.withColumn(name, build(*needs)) if len(present(df, needs)) == len(needs) else df


def clean_corrective(df: DataFrame) -> DataFrame:
    """Repair the status text, parse times and flags, zero-fill costs, add closure and start delays in hours."""
    df = _convert(df, ["etat"], lambda n: F.replace(F.col(n), F.lit(DAMAGED_STATUS), F.lit(REPAIRED_STATUS)))
    df = _convert(df, _text_columns(df, CORRECTIVE_TIMES), lambda n: parse_time(n, ORDER_TIME_FORMAT))
    df = _convert(df, _text_columns(df, CORRECTIVE_FLAGS), parse_flag)
    df = _zero_fill(df, CORRECTIVE_COSTS)
    df = _derive(df, "time_to_closure_hours", ("date_declaration", "date_cloture"), hours_between)
    return _derive(df, "time_to_start_hours", ("date_creation_ot", "date_debut_reparation"), hours_between)


def clean_preventive(df: DataFrame) -> DataFrame:
    """Parse times that are still text, zero-fill the cost, add plan deviation (days) and duration (hours)."""
    df = _convert(df, _text_columns(df, PREVENTIVE_TIMES), parse_mixed_time)
    df = _zero_fill(df, ["cout"])
    df = _derive(df, "days_deviation_from_plan", ("date_debut_planifiee", "date_debut"), days_between)
    return _derive(df, "intervention_duration_hours", ("date_debut", "date_fin"), hours_between)


def clean_spare_parts(df: DataFrame, dedupe: bool = False) -> DataFrame:
    """Parse times, zero-fill, add unit cost (0 for no quantity) and the two waiting times in hours.

    Exact duplicate lines are kept unless ``dedupe`` is set.
    """
    if dedupe:
        df = df.dropDuplicates()
    df = _convert(df, _text_columns(df, REQUEST_TIMES), lambda n: parse_time(n, REQUEST_TIME_FORMAT))
    df = _zero_fill(df, ["quantite_demande", "cout_total"])
    df = _derive(df, "cout_unitaire", ("cout_total", "quantite_demande"), guarded_ratio)
    df = _derive(df, "validation_time_hours", ("date_demande", "date_validation_superviseur"), hours_between)
    return _derive(df, "fulfillment_time_hours", ("date_validation_superviseur", "date_cloture"), hours_between)
