"""Read queries behind the service endpoints, as DataFrame-returning functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.times import seconds_label
from marketloom.operators.latest import dedup_latest, newest, newest_per_key, newest_then_ascending
from marketloom.sources.scan import scan

PRICE_FIELDS = [
    "coin_id",
    "price_date",
    "price_usd",
    "market_cap_usd",
    "volume_24h_usd",
    "price_change_pct_1d",
    "moving_avg_7d",
    "moving_avg_30d",
    "ma30_signal",
]


# The most rows that a read may ask for.
MAX_PRICES, MAX_PREDICTIONS = 1000, 500


def check_limit(limit: int, most: int) -> None:
    """A read that asks for more is an error; it is never cut silently."""
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")


def prices(
    gold: DataFrame | None,
    silver: DataFrame,
    coin_id: str,
    end: Column,
    start: Column | None = None,
    limit: int = 100,
) -> DataFrame:
    """Newest ``limit`` days of one asset in a date range, ascending; silver when gold is missing."""
    check_limit(limit, MAX_PRICES)
    table = gold if gold is not None else silver
    first = start if start is not None else F.date_sub(end, 30)
    rows = scan(table, PRICE_FIELDS, (F.col("coin_id") == coin_id) & F.col("price_date").between(first, end))
    return newest_then_ascending(rows, "price_date", limit)


def market_overview(fact: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Latest row per asset within the last days."""
    recent = fact.filter(F.col("price_date") >= F.date_sub(as_of, days))
    return newest_per_key(recent, ["coin_id"], [F.col("price_date").desc()]).select(
        "coin_id",
        F.col("price_usd").alias("current_price"),
        F.col("price_change_pct_1d").alias("price_change_24h_pct"),
        "market_cap_usd",
        "volume_24h_usd",
    )


def latest_sentiment(bronze: DataFrame) -> DataFrame:
    """The newest reading, or neutral where there is none: always one row."""
    order = F.struct("timestamp", F.to_timestamp("_ingested_at"), "value")
    found = F.max_by(F.struct("value", "classification", "timestamp"), order)
    return bronze.agg(found.alias("r")).select(
        F.coalesce("r.value", F.lit(50)).alias("value"),
        F.coalesce("r.classification", F.lit("Neutral")).alias("classification"),
        F.coalesce("r.timestamp", F.lit(0).cast("bigint")).alias("timestamp"),
    )


def sentiment_history(bronze: DataFrame) -> DataFrame:
    """One reading per day, the latest, ascending."""
    dated = bronze.select(
        "value",
        "classification",
        "timestamp",
        seconds_label(F.col("timestamp")).alias("date_str"),
        F.to_timestamp("_ingested_at").alias("ingested"),
    )
    order = [F.col("timestamp"), F.col("ingested"), F.col("value")]
    return (
        dedup_latest(dated, ["date_str"], order)
        .select("value", "classification", "timestamp", "date_str")
        .orderBy("date_str")
    )


def realtime_ohlc(bars: DataFrame, coin_id: str, as_of: Column, hours: int = 4) -> DataFrame:
    """Bars of one asset in the last hours; all its bars when that range is empty."""
    cols = ["window_start", "coin_id", "open", "high", "low", "close", "total_volume", "is_anomaly"]
    mine = scan(bars, cols, F.col("coin_id") == coin_id)
    since = as_of - F.expr(f"interval {hours} hours")
    any_recent = mine.agg(F.max("window_start").alias("m")).scalar() >= since
    rows = mine.filter((F.col("window_start") >= since) | ~F.coalesce(any_recent, F.lit(False)))
    return rows.select(
        F.col("window_start").alias("timestamp"),
        "open",
        "high",
        "low",
        "close",
        F.col("total_volume").alias("volume"),
        "is_anomaly",
    ).orderBy("timestamp")


def latest_prediction(predictions: DataFrame, coin_id: str) -> DataFrame:
    """The newest prediction of each model for one asset, the primary model marked."""
    mine = predictions.filter(F.col("coin_id") == coin_id)
    latest = newest_per_key(mine, ["model"], [F.col("ts").desc()])
    # One row per model is left, so a window over all of them stays small.
    legacy = F.max(F.col("model") == "legacy").over(Window.partitionBy(F.lit(0)))
    primary = F.when(legacy, F.lit("legacy")).otherwise(F.lit("ensemble"))
    return latest.withColumn("is_primary", F.col("model") == primary)


def prediction_history(predictions: DataFrame, model: str, coin_id: str, limit: int = 100) -> DataFrame:
    """The newest predictions of one model, oldest first."""
    check_limit(limit, MAX_PREDICTIONS)
    mine = predictions.filter((F.col("model") == model) & (F.col("coin_id") == coin_id))
    return newest_then_ascending(
        mine.select("ts", "predicted_price", "current_price", "confidence", "sentiment_bias"), "ts", limit
    )


def latest_reports(reports: DataFrame) -> DataFrame:
    """The newest report per table of an append-only report table."""
    return newest_per_key(reports, ["table_name"], [F.col("checked_at").desc()])


ALERT = "timestamp double, level string, dag_id string, task_id string, message string"


def system_alerts(raw: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest log entries, of which the well-formed alerts are returned."""
    entries = newest(raw, [F.col("position").desc()], n)
    parsed = entries.select("position", F.from_json("value", ALERT).alias("a"))
    whole = F.lit(True)
    for name in ("timestamp", "level", "dag_id", "task_id", "message"):
        whole = whole & F.col(f"a.{name}").isNotNull()
    return parsed.filter(whole).select("position", "a.*").orderBy(F.desc("position"))


def coin_list(dim: DataFrame) -> DataFrame:
    return dim.select(
        "coin_id",
        "first_tracked_date",
        "last_tracked_date",
        "total_days_tracked",
        "all_time_low",
        "all_time_high",
        "avg_price",
        "avg_daily_volume",
        "price_range_pct",
    ).orderBy(F.desc("avg_price"))


def lake_totals(dim: DataFrame, fact: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Asset count, date range, fact rows and the latest sentiment in one row."""
    coins = dim.agg(F.count(F.lit(1)).alias("n")).scalar()
    latest = sentiment.agg(
        F.max_by(F.struct("fear_greed_value", "classification"), "index_date").alias("r")
    ).scalar()
    return fact.agg(
        F.count(F.lit(1)).alias("total_fact_rows"),
        F.min("price_date").alias("date_range_start"),
        F.max("price_date").alias("date_range_end"),
    ).select(
        coins.alias("total_coins"),
        "date_range_start",
        "date_range_end",
        "total_fact_rows",
        latest["fear_greed_value"].alias("latest_fear_greed"),
        latest["classification"].alias("latest_sentiment"),
    )
