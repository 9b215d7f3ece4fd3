"""Guarded arithmetic: no expression here throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-10


def positive_or_null(x: Column) -> Column:
    return F.when(x > 0, x)


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where the divisor is zero or NULL."""
    return F.try_divide(num, den)


def pct_change(now: Column, before: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(now - before, before) * 100, digits)


def share_pct(part: Column, whole: Column, digits: int = 4) -> Column:
    """part as a percentage of a positive whole, else NULL."""
    return F.when(whole > 0, F.round(F.try_divide(part, whole) * 100, digits))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x))


def finite(x: Column) -> Column:
    """NULL and NaN become 0, +inf 0.5 and -inf -0.5."""
    bounded = F.when(F.abs(x) == F.lit(float("inf")), F.signum(x) * 0.5).otherwise(x)
    return zero_if_missing(bounded)


def zero_if_missing(x: Column) -> Column:
    """NULL and NaN become 0: what ``finite`` leaves to do on bounded values."""
    return F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))


def relative_return(now: Column, before: Column) -> Column:
    return (now - before) / (before + F.lit(EPS))


def sentiment_norm(value: Column) -> Column:
    """A 0..100 index centred on 50 and scaled to -1..1."""
    return clip((value - 50) / F.lit(50.0), -1.0, 1.0)
