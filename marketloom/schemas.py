"""Explicit schemas of the lake tables and the data contracts over them."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_B, _DATE, _TS = T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


BRONZE_TRADES = _struct(
    ("coin_id", _S, False),
    ("symbol", _S, False),
    ("price_usd", _D, False),
    ("quantity", _D, True),
    ("trade_time_ms", _L, False),
    ("event_time_ms", _L, True),
    ("ingested_at", _S, False),
    ("source", _S, False),
    ("is_buyer_maker", _B, True),
)

BRONZE_PRICES = _struct(
    ("coin_id", _S, False),
    ("timestamp_ms", _L, False),
    ("price_usd", _D, False),
    ("market_cap_usd", _D, True),
    ("volume_24h_usd", _D, True),
    ("_ingested_at", _S, False),
    ("_source", _S, False),
)

BRONZE_SENTIMENT = _struct(
    ("value", _I, False),
    ("classification", _S, False),
    ("timestamp", _L, False),
    ("time_until_update", _S, True),
    ("_ingested_at", _S, False),
    ("_source", _S, False),
)

SILVER_PRICES = _struct(
    ("coin_id", _S, False),
    ("price_date", _DATE, False),
    ("price_usd", _D, False),
    ("market_cap_usd", _D, True),
    ("volume_24h_usd", _D, True),
    ("_processed_at", _TS, False),
)

SILVER_SENTIMENT = _struct(
    ("fear_greed_value", _I, False),
    ("classification", _S, False),
    ("index_date", _DATE, False),
    ("_processed_at", _TS, False),
)

SILVER_BARS = _struct(
    ("coin_id", _S, True),
    ("window_start", _TS, True),
    ("window_end", _TS, True),
    ("vwap", _D, True),
    ("total_volume", _D, True),
    ("avg_price", _D, True),
    ("stddev_price", _D, True),
    ("open", _D, True),
    ("high", _D, True),
    ("low", _D, True),
    ("close", _D, True),
    ("z_score", _D, True),
    ("is_anomaly", _I, True),
)

CHECK_RESULTS = _struct(
    ("check_name", _S, False),
    ("layer", _S, False),
    ("table_name", _S, False),
    ("status", _S, False),
    ("metric_value", _D, True),
    ("threshold", _D, True),
    ("message", _S, True),
)

# Raw payloads.
TRADE_MESSAGE = T.StructType(
    [
        T.StructField("e", _S),
        T.StructField("s", _S),
        T.StructField("p", _S),
        T.StructField("q", _S),
        T.StructField("T", _L),
        T.StructField("E", _L),
        T.StructField("m", _B),
    ]
)
_POINTS = T.ArrayType(T.ArrayType(_D))
PRICE_HISTORY_PAYLOAD = T.StructType(
    [
        T.StructField("prices", _POINTS),
        T.StructField("market_caps", _POINTS),
        T.StructField("total_volumes", _POINTS),
    ]
)
SENTIMENT_PAYLOAD = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("value", _S),
                        T.StructField("value_classification", _S),
                        T.StructField("timestamp", _S),
                        T.StructField("time_until_update", _S),
                    ]
                )
            ),
        )
    ]
)

# Data contracts: fixed values.
CONTRACTS = {
    "bronze_realtime_prices": {
        "schema": BRONZE_TRADES,
        "minimum": {"price_usd": 0},
        "not_null": ["coin_id", "price_usd", "trade_time_ms"],
        "max_delay_seconds": 300,
        "min_records_per_hour": 1000,
    },
    "silver_daily_prices": {
        "schema": SILVER_PRICES,
        "minimum": {"price_usd": 0},
        "not_null": ["coin_id", "price_date", "price_usd"],
        "unique": ["coin_id", "price_date"],
        "max_delay_seconds": 86400,
    },
}
