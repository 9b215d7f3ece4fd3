"""Epoch and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ms_to_date(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("date")


def seconds_to_date(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("date")


def seconds_label(seconds: Column) -> Column:
    """Epoch seconds as yyyy-MM-dd, N/A where the epoch is not positive."""
    label = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")
    return F.when(seconds > 0, label).otherwise(F.lit("N/A"))


def hours_since(ts: Column, as_of: Column) -> Column:
    """Whole hours from ``ts`` to ``as_of``."""
    return F.timestamp_diff("HOUR", ts, as_of)


def calendar_columns(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date; day_of_week counts from Sunday = 1, weeks are ISO."""
    dow = F.dayofweek(day)
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": dow,
        "week_of_year": F.weekofyear(day),
        "quarter": F.quarter(day),
        "is_weekend": dow.isin(1, 7),
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
    }


def hour_cycle(ts: Column) -> tuple[Column, Column]:
    """Sine and cosine of the time of day, minutes included."""
    angle = (F.hour(ts) + F.minute(ts) / F.lit(60.0)) * F.lit(2.0) * F.pi() / F.lit(24.0)
    return F.sin(angle), F.cos(angle)
