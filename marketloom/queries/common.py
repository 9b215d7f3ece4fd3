"""Frames that several queries start from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.bars import vwap_bars
from marketloom.plans import features as feat
from marketloom.plans import forecast, gold, silver
from marketloom.session import staged
from marketloom.sources import stand_ins

# The day after the last order and the hour after the last event of the test tables.
AS_OF_DAY = dt.date(2001, 8, 2)
AS_OF_TIME = dt.datetime(2024, 1, 31)


def as_of_day() -> Column:
    return F.lit(AS_OF_DAY)


def as_of_time() -> Column:
    return F.lit(AS_OF_TIME).cast("timestamp")


def prices(spark: SparkSession, sf: str) -> DataFrame:
    return silver.daily_prices(stand_ins.bronze_prices(spark, sf))


def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return silver.daily_sentiment(stand_ins.bronze_sentiment(spark, sf))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_market_daily(prices(spark, sf), sentiment(spark, sf))


def bars(spark: SparkSession, sf: str, width: str = "30 seconds") -> DataFrame:
    return vwap_bars(stand_ins.ticks(spark, sf), width)


def silver_bars(spark: SparkSession, sf: str) -> DataFrame:
    """The bar table: computed from the trades once and written, as the lake has it."""
    return staged(bars(spark, sf), "bars")


def features(spark: SparkSession, sf: str, bar_table: DataFrame | None = None, **options) -> DataFrame:
    daily = staged(sentiment(spark, sf), "sentiment")
    return feat.build_features(bar_table if bar_table is not None else silver_bars(spark, sf), daily, **options)


def rule_votes(features_: DataFrame) -> DataFrame:
    """Probabilities from simple rules in place of fitted models, one voter sometimes absent."""
    return features_.withColumns(
        {
            "gb_prob": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.5) + F.col("return_1"))),
            "rf_prob": F.col("bb_position"),
            "lstm_prob": F.when(F.col("volume_ratio_5") > 0.1, F.col("rsi_7")),
        }
    )


def forecasts(spark: SparkSession, sf: str, bar_table: DataFrame | None = None) -> DataFrame:
    return forecast.trend_forecast(forecast.blend(rule_votes(features(spark, sf, bar_table))))


def predictions(spark: SparkSession, sf: str, bar_table: DataFrame | None = None) -> DataFrame:
    """Two models' predictions for every bar: the blended forecast and the five-bar mean."""
    price, mean = F.col("price"), F.col("sma_5")

    def model(name: str, predicted: Column, confidence: Column, bias: Column) -> Column:
        return F.struct(
            F.lit(name).alias("model"),
            predicted.alias("predicted_price"),
            confidence.alias("confidence"),
            bias.alias("sentiment_bias"),
        )

    both = F.array(
        model("ensemble", F.col("predicted_price"), F.col("confidence"), F.col("sentiment_bias")),
        model("legacy", mean, F.lit(0.5), F.when(mean > price, "Bullish").otherwise("Bearish")),
    )
    rows = forecasts(spark, sf, bar_table).select("coin_id", "ts", "price", F.explode(both).alias("m"))
    return rows.select(
        "m.model",
        "coin_id",
        "ts",
        "m.predicted_price",
        F.col("price").alias("current_price"),
        "m.confidence",
        "m.sentiment_bias",
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
