"""Column expressions. Everything stays in generated JVM code; nothing raises on a zero divisor or bad text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tsengine.series import floor_time

# Upper edges (inclusive) and names of the category bands, and the alert thresholds.
BANDS = (
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy (Sensitive)"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
)
TOP_BAND = "Hazardous"
ALERTS = ((200, "severe"), (150, "sensitive"))
NO_ALERT = "none"


def calendar_parts(time: Column) -> dict[str, Column]:
    weekday = F.weekday(time)  # Monday = 0
    return {
        "hour": F.hour(time),
        "day": F.day(time),
        "month": F.month(time),
        "day_of_week": weekday,
        "day_of_year": F.dayofyear(time),
        "week_of_year": F.weekofyear(time),
        "is_weekend": (weekday >= 5).cast("int"),
    }


# The period of each cyclically encoded calendar part.
CYCLES = {"hour": 24.0, "day_of_week": 7.0, "month": 12.0, "day_of_year": 365.25}


def on_circle(value: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of a value that repeats every ``period``; also turns degrees into components (period 360)."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def safe_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def percent_change(value: Column, previous: Column) -> Column:
    return F.try_divide(value - previous, previous) * 100


def finite_or_null(column: Column) -> Column:
    return F.when(F.isnan(column) | (F.abs(column) == float("inf")), None).otherwise(column)


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the non-null values of a row."""
    return F.try_divide(_row_sum(columns), _row_count(columns))


def row_std(columns: Sequence[Column], mean: Column) -> Column:
    """Sample deviation of the non-null values of a row around their ``mean``; null below two values."""
    squares = _row_sum([(c - mean) * (c - mean) for c in columns])
    n = _row_count(columns)
    return F.when(n >= 2, F.sqrt(F.try_divide(squares, n - 1)))


def _row_sum(columns: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c.cast("double"), F.lit(0.0))
    return total


def _row_count(columns: Sequence[Column]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + c.isNotNull().cast("int")
    return total


def band(value: Column, bands: Sequence[tuple[float, str]] = BANDS, top: str = TOP_BAND) -> Column:
    out = None
    for edge, name in bands:
        out = F.when(value <= edge, name) if out is None else out.when(value <= edge, name)
    return F.when(value.isNotNull(), out.otherwise(top))


def alert(values: Sequence[Column], alerts: Sequence[tuple[float, str]] = ALERTS) -> Column:
    peak = F.greatest(*values) if len(values) > 1 else values[0]
    out = None
    for edge, name in alerts:
        out = F.when(peak >= edge, name) if out is None else out.when(peak >= edge, name)
    return F.when(peak.isNotNull(), out.otherwise(NO_ALERT))


def direction(change: Column) -> Column:
    return F.when(change > 0, "up").when(change < 0, "down").when(change == 0, "flat")


def reconstruct(current: Column, change: Column, clamp: bool) -> Column:
    """Null in, null out: ``greatest`` alone would serve a missing change as level 0."""
    level = current + change
    return F.when(level.isNotNull(), F.greatest(F.lit(0.0), level)) if clamp else level


def blend(parts: Sequence[tuple[float, Column]]) -> Column:
    total = None
    for weight, column in parts:
        total = column * weight if total is None else total + column * weight
    return total


def floor_hour(time: Column) -> Column:
    return floor_time(time, 3600)


def format_time(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def close(a: Column, b: Column, atol: float = 1e-8, rtol: float = 1e-5) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def parse_time(text: Column, formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss")) -> Column:
    """First format that fits, then any ISO form; null when none does."""
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries, text.try_cast("timestamp_ntz"))


def parse_number(text: Column) -> Column:
    """Bad text and NaN become null."""
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
