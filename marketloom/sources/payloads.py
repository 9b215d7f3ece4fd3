"""API payloads (nested JSON arrays) to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.schemas import PRICE_HISTORY_PAYLOAD, SENTIMENT_PAYLOAD

PRICE_SOURCE = "coingecko"
SENTIMENT_SOURCE = "fear_greed_index"


def price_history_rows(payloads: DataFrame, value: str = "value", carry: list[str] | None = None) -> DataFrame:
    """One row per price point; capitalisation and volume are taken by position, short arrays give NULL.

    The arrays are zipped before the explode, so an exploded row carries its own point only.
    """
    carry = carry or ["coin_id"]
    doc = payloads.select(*carry, F.from_json(value, PRICE_HISTORY_PAYLOAD).alias("d"))
    return _points(doc, carry, 0)


def _points(doc: DataFrame, carry: list[str], min_points: int) -> DataFrame:
    """The points of the parsed payload ``d``, none of a payload with fewer than ``min_points``.

    A short payload explodes into nothing; a filter would be pushed below the parse and repeat it.
    """
    none = F.array().cast("array<array<double>>")
    n = F.size("d.prices")
    taken = F.when(n >= min_points, n).otherwise(0)
    zipped = F.arrays_zip(
        F.col("d.prices").alias("p"),
        F.coalesce("d.market_caps", none).alias("c"),
        F.coalesce("d.total_volumes", none).alias("v"),
    )
    points = doc.select(*carry, F.explode(F.slice(zipped, F.lit(1), taken)).alias("z"))
    return points.select(
        *carry,
        F.try_element_at("z.p", F.lit(1)).cast("bigint").alias("timestamp_ms"),
        F.try_element_at("z.p", F.lit(2)).alias("price_usd"),
        F.try_element_at("z.c", F.lit(2)).alias("market_cap_usd"),
        F.try_element_at("z.v", F.lit(2)).alias("volume_24h_usd"),
    )


def hourly_training_rows(
    payloads: DataFrame, value: str = "value", series: list[str] | None = None, min_points: int = 10
) -> DataFrame:
    """Price points for training: a missing volume is 0 and payloads under ``min_points`` are dropped.

    The length test reads the array parsed once, so no count over exploded rows is needed.
    """
    series = series or ["coin_id"]
    doc = payloads.select(*series, F.from_json(value, PRICE_HISTORY_PAYLOAD).alias("d"))
    return _points(doc, series, min_points).select(
        *series,
        F.timestamp_millis("timestamp_ms").alias("timestamp"),
        "price_usd",
        F.coalesce("volume_24h_usd", F.lit(0.0)).alias("volume_usd"),
    )


def sentiment_rows(payloads: DataFrame, value: str = "value") -> DataFrame:
    """One row per index reading; numbers arrive as strings."""
    doc = payloads.select(F.explode(F.from_json(value, SENTIMENT_PAYLOAD)["data"]).alias("r"))
    return doc.select(
        F.col("r.value").try_cast("int").alias("value"),
        F.col("r.value_classification").alias("classification"),
        F.col("r.timestamp").try_cast("bigint").alias("timestamp"),
        F.col("r.time_until_update").alias("time_until_update"),
    )
