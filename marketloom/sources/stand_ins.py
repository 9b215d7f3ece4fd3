"""Bronze tables derived from the TPC-H-like test tables.

The assets are the order priorities and the event types. Everything is a whole-table query, and
every payload is made from one row, so that none grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.labels import sentiment_band
from marketloom.operators.bars import trade_ticks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(seconds) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def bronze_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily price history: one row per order, several per asset and day."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    volume = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("volume_24h_usd"))
    )
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(volume, "o_orderkey", "left")
        .select(
            F.col("o_orderpriority").alias("coin_id"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("timestamp_ms"),
            F.col("o_totalprice").alias("price_usd"),
            F.col("c_acctbal").alias("market_cap_usd"),
            "volume_24h_usd",
            _iso(F.col("o_orderkey")).alias("_ingested_at"),
            F.lit("orders").alias("_source"),
        )
    )


def bronze_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment readings: one per order line, about as many per day as there are lines."""
    line = table(spark, sf_dir, "lineitem")
    value = F.round(F.col("l_discount") * 1000).cast("int")
    return line.select(
        value.alias("value"),
        sentiment_band(value).alias("classification"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.lit("43200").alias("time_until_update"),
        _iso(F.col("l_orderkey") * 20 + F.col("l_linenumber")).alias("_ingested_at"),
        F.lit("lineitem").alias("_source"),
    )


def bronze_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return trades_of_events(events)


def trades_of_events(events: DataFrame) -> DataFrame:
    """Events as trades; works on a batch and on a streaming frame."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_type").alias("coin_id"),
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price_usd"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.unix_millis(ts).alias("trade_time_ms"),
        F.unix_millis(ts).alias("event_time_ms"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("ingested_at"),
        F.lit("events").alias("source"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_ticks(bronze_trades(spark, sf_dir))


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trade messages, one per event: plain, enveloped, another event type, ill-typed or broken."""
    fixed_pairs = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "ADAUSDT", "DOTUSDT", "LINKUSDT", "AVAXUSDT", "MATICUSDT"]
    events = table(spark, sf_dir, "events")
    user = F.col("user_id")
    pairs = F.array(*[F.lit(p) for p in fixed_pairs])
    symbol = F.when(user % 9 == 8, F.upper("event_type")).otherwise(F.get(pairs, (user % 9).cast("int")))
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    body = F.to_json(
        F.struct(
            F.when(user % 10 == 3, "trade").otherwise("aggTrade").alias("e"),
            symbol.alias("s"),
            F.when(user % 11 == 5, "n/a").otherwise(F.col("value").cast("string")).alias("p"),
            F.get_json_object("props", "$.k").alias("q"),
            millis.alias("T"),
            F.when(user % 3 > 0, millis + 1).alias("E"),
            F.when(user % 4 > 0, user % 2 == 0).alias("m"),
        )
    )
    value = (
        F.when(user % 7 == 6, F.concat(F.lit('{"stream":"x","data":'), body, F.lit("}")))
        .when(user % 13 == 12, F.concat(F.lit("<"), body))
        .otherwise(body)
    )
    return events.select("event_id", value.alias("value"))


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price-history payloads: one per order with 8 to 12 hourly points.

    Odd orders lack the last volume and every seventh has no capitalisations, so that short and
    missing arrays occur.
    """
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    hours = F.sequence(F.lit(0).cast("bigint"), 7 + key % 5)

    def points(of) -> Column:
        return F.transform(hours, lambda i: F.array((start + i * 3600000).cast("double"), of(i).cast("double")))

    prices = points(lambda i: F.col("o_totalprice") + i)
    caps = F.when(key % 7 > 0, points(lambda i: F.col("o_custkey") * 1000 + i))
    volumes = points(lambda i: key % 100 + i)
    short = F.slice(volumes, F.lit(1), F.size(volumes) - (key % 2).cast("int"))
    payload = F.to_json(
        F.struct(prices.alias("prices"), caps.alias("market_caps"), short.alias("total_volumes"))
    )
    return orders.select(F.col("o_orderpriority").alias("coin_id"), payload.alias("value"))


def sentiment_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment payloads: one per order line with two readings half a day apart, numbers as strings."""
    value = F.round(F.col("l_discount") * 1000).cast("int")
    at = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))

    def reading(v: Column, seconds: Column) -> Column:
        return F.struct(
            v.cast("string").alias("value"),
            sentiment_band(v).alias("value_classification"),
            seconds.cast("string").alias("timestamp"),
            F.lit("43200").alias("time_until_update"),
        )

    both = F.array(reading(value, at), reading(100 - value, at + 43200))
    return table(spark, sf_dir, "lineitem").select(F.to_json(F.struct(both.alias("data"))).alias("value"))
