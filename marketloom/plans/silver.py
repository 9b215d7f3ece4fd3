"""Bronze to silver: typed, deduplicated, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.numbers import positive_or_null
from marketloom.functions.times import ms_to_date, seconds_to_date
from marketloom.operators.latest import dedup_latest_fixed
from marketloom.operators.merge import upsert

PRICE_KEY = ["coin_id", "price_date"]
SENTIMENT_KEY = ["index_date"]
DAY_S, DAY_MS = 86_400, 86_400_000


def _stamped(df: DataFrame, as_of: Column | None) -> DataFrame:
    return df if as_of is None else df.withColumn("_processed_at", as_of.cast("timestamp"))


def _load_order(step: int) -> Column:
    """Microseconds from 2000 to the load, times ``step``; rows without a load time come first."""
    micros = F.coalesce(F.unix_micros("ingested") - F.lit(946_684_800_000_000), F.lit(0))
    return micros.cast("decimal(19,0)") * F.lit(step).cast("decimal(9,0)")


def daily_prices(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest ingested price per asset and day, positive prices only, non-positive measures to NULL.

    The ISO ingestion time is parsed, so differing offsets still order rightly; rows of one load
    time are ordered by their time of day, then by price.
    """
    dated = bronze.select(
        "coin_id",
        ms_to_date(F.col("timestamp_ms")).alias("price_date"),
        "timestamp_ms",
        "price_usd",
        "market_cap_usd",
        "volume_24h_usd",
        F.to_timestamp("_ingested_at").alias("ingested"),
    )
    order = _load_order(DAY_MS) + F.pmod("timestamp_ms", F.lit(DAY_MS))
    latest = dedup_latest_fixed(dated, PRICE_KEY, order, "price_usd", ["market_cap_usd", "volume_24h_usd"])
    cleaned = latest.filter(F.col("price_usd") > 0).select(
        "coin_id",
        "price_date",
        "price_usd",
        positive_or_null(F.col("market_cap_usd")).alias("market_cap_usd"),
        positive_or_null(F.col("volume_24h_usd")).alias("volume_24h_usd"),
    )
    return _stamped(cleaned, as_of)


def daily_sentiment(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest ingested reading per calendar day; the key is the date, as in the merge."""
    dated = bronze.select(
        seconds_to_date(F.col("timestamp")).alias("index_date"),
        "timestamp",
        "value",
        "classification",
        F.to_timestamp("_ingested_at").alias("ingested"),
    )
    order = _load_order(DAY_S) + F.pmod("timestamp", F.lit(DAY_S))
    # The class has no fixed width: its hash goes through the aggregates, and finds it again at the end.
    hashed = dated.withColumn("_class", F.xxhash64("classification"))
    latest = dedup_latest_fixed(hashed, SENTIMENT_KEY, order, "value", ["_class"])
    classes = hashed.select(F.col("_class").alias("_of"), F.col("classification").alias("_name")).distinct()
    latest = latest.join(classes.hint("shuffle_hash"), F.col("_class") == F.col("_of")).withColumn("classification", F.col("_name"))
    return _stamped(latest.select(F.col("value").alias("fear_greed_value"), "classification", "index_date"), as_of)


def load_daily_prices(spark: SparkSession, path: str, bronze: DataFrame, as_of: Column) -> None:
    """Upsert into the silver price table.

    The table is laid out by month: a daily load touches the newest months only, where a layout
    by asset would rewrite the whole history of every asset.
    """
    rows = daily_prices(bronze, as_of).withColumn("price_month", F.date_format("price_date", "yyyy-MM"))
    upsert(spark, path, rows, PRICE_KEY, ["price_month"], ["coin_id", "price_date"])


def load_daily_sentiment(spark: SparkSession, path: str, bronze: DataFrame, as_of: Column) -> None:
    rows = daily_sentiment(bronze, as_of).withColumn("index_year", F.year("index_date"))
    upsert(spark, path, rows, SENTIMENT_KEY, ["index_year"], ["index_date"])
