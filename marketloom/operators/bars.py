"""VWAP and OHLC bars over trades; the same expressions run on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numbers import ratio

_TIE_BITS = 20


def tick_order(time_ms: Column, *tie_breakers: Column) -> Column:
    """A total order over trades as one long: milliseconds, then a hash of the row.

    A long keeps min_by/max_by in a fixed-width buffer, so the bar aggregation stays a hash
    aggregation; ordering by a struct would turn it into a sort aggregation.
    """
    tie = F.xxhash64(*tie_breakers).bitwiseAND(F.lit((1 << _TIE_BITS) - 1))
    return F.shiftleft(time_ms, _TIE_BITS).bitwiseOR(tie)


def trade_ticks(trades: DataFrame) -> DataFrame:
    """Trades with event time, notional and the tick order used for open and close."""
    return trades.select(
        "coin_id",
        F.timestamp_millis("trade_time_ms").alias("trade_time"),
        "price_usd",
        "quantity",
        (F.col("price_usd") * F.col("quantity")).alias("notional"),
        tick_order(F.col("trade_time_ms"), F.col("price_usd"), F.col("quantity")).alias("tick"),
    )


def ohlc_columns(price: str = "price_usd", order: str = "tick") -> list[Column]:
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
    ]


def vwap_bars(
    ticks: DataFrame, width: str = "30 seconds", slide: str | None = None, z_limit: float = 3.0
) -> DataFrame:
    """Windowed VWAP, OHLC, volume, mean, deviation, z-score and anomaly flag per asset."""
    bar = F.window("trade_time", width, slide) if slide else F.window("trade_time", width)
    grouped = ticks.groupBy("coin_id", bar.alias("bar")).agg(
        ratio(F.sum("notional"), F.sum("quantity")).alias("vwap"),
        F.sum("quantity").alias("total_volume"),
        F.avg("price_usd").alias("avg_price"),
        F.stddev("price_usd").alias("stddev_price"),
        *ohlc_columns(),
    )
    z = ratio(F.col("vwap") - F.col("avg_price"), F.col("stddev_price"))
    return grouped.withColumn("z_score", z).select(
        "coin_id",
        F.col("bar.start").alias("window_start"),
        F.col("bar.end").alias("window_end"),
        "vwap",
        "total_volume",
        "avg_price",
        "stddev_price",
        "open",
        "high",
        "low",
        "close",
        "z_score",
        F.when(F.abs("z_score") > z_limit, 1).otherwise(0).alias("is_anomaly"),
    )


def hourly_prices(ticks: DataFrame) -> DataFrame:
    """Hourly price facts: one grouped pass instead of window functions plus DISTINCT."""
    return ticks.groupBy("coin_id", F.date_trunc("hour", "trade_time").alias("price_hour")).agg(
        F.avg("price_usd").alias("avg_price"),
        F.min("price_usd").alias("min_price"),
        F.max("price_usd").alias("max_price"),
        F.min_by("price_usd", "tick").alias("open_price"),
        F.max_by("price_usd", "tick").alias("close_price"),
        F.sum("quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("trade_count"),
    )


def ohlc_1h(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("coin_id", F.date_trunc("hour", "trade_time").alias("bucket_start")).agg(
        *ohlc_columns(), F.sum("quantity").alias("volume")
    )


def reaggregate(bars: DataFrame, width: str) -> DataFrame:
    """Wider bars from narrower ones, without going back to the trades."""
    start = F.window("bucket_start", width)["start"]
    return bars.groupBy("coin_id", start.alias("wide_start")).agg(
        F.min_by("open", "bucket_start").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bucket_start").alias("close"),
        F.sum("volume").alias("volume"),
    ).withColumnRenamed("wide_start", "bucket_start")


def market_ohlc(ticks: DataFrame, wider: dict[str, str] | None = None) -> DataFrame:
    """1h bars plus 4h and 1d bars rebuilt from them, one row per asset, bucket and timeframe."""
    return widened(ohlc_1h(ticks), wider)


def widened(hours: DataFrame, wider: dict[str, str] | None = None) -> DataFrame:
    """Hourly bars with the wider ones made from them.

    The wide bars come from one pass over the hourly bars: each bar is repeated once per
    timeframe (a fixed, small number) and grouped with the timeframe as part of the key.
    """
    wider = wider or {"4h": "4 hours", "1d": "1 day"}
    starts = [
        F.struct(F.lit("1h").alias("timeframe"), F.col("hour_start").alias("bucket_start")),
        *[
            F.struct(F.lit(name).alias("timeframe"), _floor_to(F.col("hour_start"), width).alias("bucket_start"))
            for name, width in wider.items()
        ],
    ]
    hours = hours.withColumnRenamed("bucket_start", "hour_start")
    return (
        hours.withColumn("b", F.explode(F.array(*starts)))
        .groupBy("coin_id", F.col("b.bucket_start").alias("bucket_start"), F.col("b.timeframe").alias("timeframe"))
        .agg(
            F.min_by("open", "hour_start").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "hour_start").alias("close"),
            F.sum("volume").alias("volume"),
        )
    )


def hour_states(ticks: DataFrame) -> DataFrame:
    """What is known of each asset and hour; states of other trades of the hour merge with it."""
    return ticks.groupBy("coin_id", F.date_trunc("hour", "trade_time").alias("price_hour")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("price_usd").alias("n_prices"),
        F.sum("price_usd").alias("price_sum"),
        F.sum("quantity").alias("quantity"),
        F.min("tick").alias("first_tick"),
        F.max("tick").alias("last_tick"),
        *ohlc_columns(),
    )


def merged_states(states: DataFrame) -> DataFrame:
    return states.groupBy("coin_id", "price_hour").agg(
        *[F.sum(c).alias(c) for c in ("n", "n_prices", "price_sum", "quantity")],
        F.min_by("open", "first_tick").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_tick").alias("close"),
    )


def hourly_of_states(states: DataFrame) -> DataFrame:
    """As :func:`hourly_prices`, from merged states."""
    return states.select(
        "coin_id", "price_hour",
        ratio(F.col("price_sum"), F.col("n_prices")).alias("avg_price"),
        F.col("low").alias("min_price"), F.col("high").alias("max_price"),
        F.col("open").alias("open_price"), F.col("close").alias("close_price"),
        F.col("quantity").alias("total_quantity"), F.col("n").alias("trade_count"),
    )


def ohlc_of_states(states: DataFrame) -> DataFrame:
    """As :func:`market_ohlc`, from merged states."""
    hours = states.select("coin_id", F.col("price_hour").alias("bucket_start"), "open", "high", "low", "close", F.col("quantity").alias("volume"))
    return widened(hours)


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(width: str) -> int:
    """'4 hours' as seconds."""
    count, unit = width.split()
    return int(count) * _UNIT_SECONDS[unit.rstrip("s")]


def _floor_to(ts: Column, width: str) -> Column:
    step = seconds_of(width)
    secs = F.unix_seconds(ts)
    return F.timestamp_seconds(secs - F.pmod(secs, F.lit(step)))
