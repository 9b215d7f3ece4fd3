"""Categorical labels: sentiment scores and trading signals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentiment classes from most fearful to most greedy.
CLASSES = ["Extreme Fear", "Fear", "Neutral", "Greed", "Extreme Greed"]
# Upper bounds of the first four sentiment bands.
BAND_LIMITS = [25, 45, 55, 75]


def sentiment_score(classification: Column) -> Column:
    """1 for the most fearful class up to 5, NULL for unknown labels."""
    score = F.array_position(F.array(*map(F.lit, CLASSES)), classification)
    return F.nullif(score, F.lit(0).cast("bigint")).cast("int")


def sentiment_band(value: Column) -> Column:
    out = F.lit(CLASSES[-1])
    for limit, name in reversed(list(zip(BAND_LIMITS, CLASSES))):
        out = F.when(value < limit, F.lit(name)).otherwise(out)
    return F.when(value.isNotNull(), out)


def trend_signal(price: Column, average: Column, mode: str = "tri") -> Column:
    """Price against its 30-row mean: three-valued, or two-valued with mode='binary'."""
    if mode == "binary":
        return F.when(price > average, "ABOVE_MA30").otherwise("BELOW_MA30")
    return (
        F.when(price > average, "ABOVE_MA30").when(price < average, "BELOW_MA30").otherwise("AT_MA30")
    )


def contrarian_signal(price: Column, average: Column, sentiment: Column) -> Column:
    return (
        F.when((price < average) & (sentiment < 25), "POTENTIAL_BUY")
        .when((price > average) & (sentiment > 75), "POTENTIAL_SELL")
        .otherwise("HOLD")
    )


def change_class(change_pct: Column) -> Column:
    """Technical class of a one-day change in percent; a missing change counts as 0."""
    c = F.coalesce(change_pct, F.lit(0.0))
    return (
        F.when(c < -5, "OVERSOLD")
        .when(c < -2, "WEAK")
        .when(c > 5, "OVERBOUGHT")
        .when(c > 2, "STRONG")
        .otherwise("NEUTRAL")
    )


def matrix_signal(sentiment: Column, change_pct: Column) -> Column:
    v, c = F.coalesce(sentiment, F.lit(50)), F.coalesce(change_pct, F.lit(0.0))
    return F.when((v < 30) & (c < -2), "BUY").when((v > 70) & (c > 2), "SELL").otherwise("HOLD")


def reliability(direction_accuracy: Column, mape: Column) -> Column:
    return (
        F.when((direction_accuracy >= 60) & (mape < 2), "HIGH")
        .when((direction_accuracy >= 50) & (mape < 5), "MEDIUM")
        .otherwise("LOW")
    )


def bias(predicted: Column, current: Column) -> Column:
    return (
        F.when(predicted > current, "Bullish").when(predicted < current, "Bearish").otherwise("Neutral")
    )


def lag_status(lag_seconds: Column, limit: int = 300) -> Column:
    return F.when(lag_seconds.isNull(), "EMPTY").when(lag_seconds < limit, "OK").otherwise("DELAYED")
