"""Column helpers shared by all plans.

Every helper maps NULL to NULL, never divides by zero (the session stays in ANSI mode) and stays inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

# The text formats of the order and part-request exports.  Single pattern letters accept
# both padded and unpadded numbers.
ORDER_TIME_FORMAT = "d/M/yyyy H:m"
REQUEST_TIME_FORMAT = "d/M/yyyy, H:m:s"
DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d-M-yyyy", "d.M.yyyy")
MIXED_TIME_FORMATS = tuple(f"{date}{time}" for date in DATE_FORMATS for time in (" H:m:s", " H:m", ""))

# The weekday labels of the dashboards, Monday first.
WEEKDAY_LABELS = ("Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim")


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(column(end)) - F.unix_micros(column(start))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed hours as a double."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_HOUR))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed days as a double."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Completed 24-hour periods (floor), which differs from the calendar-day difference."""
    return F.floor(days_between(start, end)).cast("long")


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL when the denominator is 0."""
    return F.try_divide(column(numerator).cast("double"), column(denominator).cast("double"))


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient where the denominator is positive, otherwise 0."""
    return F.when(column(denominator) > 0, safe_ratio(numerator, denominator)).otherwise(F.lit(0.0))


def percent(part: Column | str, whole: Column | str) -> Column:
    return safe_ratio(part, whole) * 100


def parse_time(text: Column | str, *formats: str) -> Column:
    """First format that parses; unparseable text becomes NULL instead of raising."""
    return F.coalesce(*[F.try_to_timestamp(column(text), F.lit(fmt)) for fmt in formats])


def parse_mixed_time(text: Column | str) -> Column:
    """ISO text first, then month-first dates, then day-first dates and month names."""
    raw = column(text)
    return F.coalesce(F.try_to_timestamp(raw), *[F.try_to_timestamp(raw, F.lit(f)) for f in MIXED_TIME_FORMATS])


def parse_flag(text: Column | str) -> Column:
    raw = column(text)
    return F.when(raw.isin("Oui", "oui"), F.lit(True)).when(raw.isin("Non", "non"), F.lit(False))


def finite(value: Column | str) -> Column:
    """NaN and infinities become NULL."""
    number = column(value).cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(number)


def indicator(predicate: Column) -> Column:
    """0/1, where an unknown predicate counts as 0."""
    return F.coalesce(predicate, F.lit(False)).cast("long")


def weekday_label(weekday: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(label) for label in WEEKDAY_LABELS]), column(weekday) + 1)


def year_month(time: Column | str) -> Column:
    return F.date_format(column(time), "yyyy-MM")


def risk_band(probability: Column | str) -> Column:
    """Above 0.5 high, above 0.3 medium, else low; bounds belong to the lower band."""
    value = column(probability)
    return F.when(value > 0.5, "high").when(value > 0.3, "medium").when(value.isNotNull(), "low")


def clamp_unit(value: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), column(value)))


def text_or_nan(value: Column | str) -> Column:
    """Text form in which a missing value is the category ``nan``."""
    return F.coalesce(column(value).cast("string"), F.lit("nan"))


def flag_name(prefix: str, label: str, length: int = 50) -> str:
    """Column name for a category: spaces to underscores, lower case, cut to ``length``."""
    return f"{prefix}_{label.replace(' ', '_').lower()}"[:length]


def quoted(name: str) -> Column:
    """Column reference that survives dots and accents in generated names."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The subset of ``names`` that exists in ``df``, in the given order."""
    existing = set(df.columns)
    return [name for name in names if name in existing]


def none_null(names: Sequence[str]) -> Column:
    predicate = F.lit(True)
    for name in names:
        predicate = predicate & F.col(name).isNotNull()
    return predicate
