"""The daily run: bronze to silver to gold, then checks, over one folder of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.merge import write_table
from marketloom.plans import gold, quality, silver
from marketloom.session import staged
from marketloom.sources.scan import read_optional
from marketloom.streaming import loads

SILVER_PRICES, SILVER_SENTIMENT = "silver/daily_prices", "silver/fear_greed"
DIM_COINS, DIM_DATES = "gold/dim_coins", "gold/dim_dates"
FACT, HOURLY, OHLC = "gold/fact_market_daily", "gold/fact_price_hourly", "gold/market_ohlc"
CHECKS, REPORTS = "quality/check_results", "quality/table_reports"


def load(
    spark: SparkSession,
    root: str,
    prices: DataFrame,
    sentiment: DataFrame,
    trades: str | None,
    as_of: Column,
) -> None:
    """Merge new bronze rows into silver, refresh the dimensions and extend the facts.

    ``trades`` is the path of the bronze trade table, of which only unread files are read.

    Each layer reads the written tables of the one before, so a lost executor repeats one layer
    at most and the planner knows the sizes of what it joins.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}")

    silver.load_daily_prices(spark, f"{root}/{SILVER_PRICES}", prices, as_of)
    silver.load_daily_sentiment(spark, f"{root}/{SILVER_SENTIMENT}", sentiment, as_of)
    write_table(gold.dim_coins(table(SILVER_PRICES)), f"{root}/{DIM_COINS}", [])
    write_table(gold.dim_dates(table(SILVER_PRICES)), f"{root}/{DIM_DATES}", [])
    gold.load_fact(spark, f"{root}/{FACT}", table(SILVER_PRICES), table(SILVER_SENTIMENT))
    if trades is not None:
        loads.load_hourly(spark, f"{root}/{HOURLY}", trades)
        loads.load_ohlc(spark, f"{root}/{OHLC}", trades)


def _store(rows: DataFrame, path: str, as_of: Column) -> None:
    """Results of one run are one partition, replaced when the run is repeated."""
    stamped = rows.withColumn("checked_at", as_of.cast("timestamp"))
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("checked_at").parquet(path)


def check(
    spark: SparkSession,
    root: str,
    as_of: Column,
    bronze: dict[str, DataFrame | None] | None = None,
    bars: DataFrame | None = None,
) -> DataFrame:
    """Run the checks of all layers, store results and per-table reports, return the results.

    A table that does not exist is a failed row and checks that break are an error row, in every
    layer; the run goes on. ``bronze`` and ``bars`` are checked when they are given.
    """

    def table(name: str) -> DataFrame | None:
        return read_optional(spark, f"{root}/{name}")

    coins, dates, fact = table(DIM_COINS), table(DIM_DATES), table(FACT)
    parts = [
        quality.guarded(spark, "silver", "daily_prices", table(SILVER_PRICES), lambda t: quality.silver_price_checks(t, as_of)),
        quality.guarded(spark, "silver", "fear_greed", table(SILVER_SENTIMENT), quality.silver_sentiment_checks),
    ]
    missing = [n for n, t in (("dim_coins", coins), ("dim_dates", dates), ("fact_market_daily", fact)) if t is None]
    if missing:
        parts += [quality.table_exists(spark, None, "gold", n) for n in missing]
    else:
        parts.append(quality.guarded(spark, "gold", "fact_market_daily", fact, lambda t: quality.gold_checks(t, coins, dates)))
    if bronze is not None:
        parts.append(quality.bronze_checks(spark, bronze, as_of))
    if bars is not None:
        parts.append(quality.guarded(spark, "silver", "realtime_vwap", bars, quality.silver_bar_checks))
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    stored = staged(results, "results")
    _store(stored, f"{root}/{CHECKS}", as_of)
    _store(quality.table_reports(stored), f"{root}/{REPORTS}", as_of)
    return stored.withColumn("checked_at", as_of.cast("timestamp"))
