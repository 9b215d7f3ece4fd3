"""Exchange trade messages: unwrap, parse, normalise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.match import lookup_or_self
from marketloom.schemas import BRONZE_TRADES

# Exchange pair to asset id.
PAIR_TO_ASSET = {
    "btcusdt": "bitcoin",
    "ethusdt": "ethereum",
    "solusdt": "solana",
    "adausdt": "cardano",
    "dotusdt": "polkadot",
    "linkusdt": "chainlink",
    "avaxusdt": "avalanche-2",
    "maticusdt": "matic-network",
}
TRADE_EVENT = "aggTrade"
TRADE_SOURCE = "binance_websocket"

_FIELDS = "e string, s string, p string, q string, T string, E string, m string"
_MESSAGE = f"data struct<{_FIELDS.replace(' string', ': string')}>, {_FIELDS}, _corrupt string"
# Column names ignore case, so parsed structs are renamed by position: e and E would clash.
_TRADE = ["event", "symbol", "price", "quantity", "trade_ms", "event_ms", "maker"]
_NAMES = ", ".join(f"{name}: string" for name in _TRADE)
_NAMED = f"struct<envelope: struct<{_NAMES}>, {_NAMES}, corrupt: string>"


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse the trade fields, plain or inside a {"data": ...} envelope, in one pass over the JSON.

    Adds ``msg`` and ``problem``: NULL for a usable trade, else why it is set aside
    (not JSON, another event type, or a field of the wrong type).
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    doc = F.from_json(value, _MESSAGE, options).cast(_NAMED)

    def unwrap(d: Column) -> Column:
        plain = F.struct(*[d[name].alias(name) for name in _TRADE])
        bad = d.isNull() | d["corrupt"].isNotNull()
        return F.struct(F.coalesce(d["envelope"], plain).alias("msg"), bad.alias("bad"))

    # A generator over one element: the document is parsed once, not once per field used below.
    parsed = raw.select("*", F.inline(F.transform(F.array(doc), unwrap)))
    msg = F.col("msg")

    def ill(name: str, dtype: str) -> Column:
        return msg[name].isNotNull() & msg[name].try_cast(dtype).isNull()

    ill_typed = (
        ill("price", "double")
        | ill("quantity", "double")
        | ill("trade_ms", "bigint")
        | ill("event_ms", "bigint")
        | ill("maker", "boolean")
    )
    problem = (
        F.when(F.col("bad"), "malformed")
        .when(~msg["event"].eqNullSafe(F.lit(TRADE_EVENT)), "other_event")
        .when(ill_typed, "ill_typed")
    )
    return parsed.withColumn("problem", problem).drop("bad")


def normalise(parsed: DataFrame, ingested_at: Column) -> DataFrame:
    """Parsed messages as bronze trades; missing fields take the documented defaults."""
    msg = F.col("msg")

    def field(name: str, dtype: str, default) -> Column:
        return F.coalesce(msg[name].try_cast(dtype), F.lit(default).cast(dtype))

    symbol = F.coalesce(msg["symbol"], F.lit(""))
    return parsed.select(
        lookup_or_self(F.lower(symbol), PAIR_TO_ASSET).alias("coin_id"),
        symbol.alias("symbol"),
        field("price", "double", 0.0).alias("price_usd"),
        field("quantity", "double", 0.0).alias("quantity"),
        field("trade_ms", "bigint", 0).alias("trade_time_ms"),
        field("event_ms", "bigint", 0).alias("event_time_ms"),
        ingested_at.cast("string").alias("ingested_at"),
        F.lit(TRADE_SOURCE).alias("source"),
        field("maker", "boolean", False).alias("is_buyer_maker"),
    )


def trades_from_messages(raw: DataFrame, ingested_at: Column, value: str = "value") -> DataFrame:
    """Usable trades of a raw message table."""
    return normalise(parse_messages(raw, value).filter(F.col("problem").isNull()), ingested_at)


def quarantined(raw: DataFrame, value: str = "value") -> DataFrame:
    """Messages set aside, with the reason. Other event types are skipped, not quarantined."""
    parsed = parse_messages(raw, value)
    return parsed.filter(F.col("problem").isin("malformed", "ill_typed")).select(value, "problem")


def to_topic(trades: DataFrame) -> DataFrame:
    """Key and value columns for a keyed topic; the key keeps the order of one asset."""
    return trades.select(
        F.col("coin_id").cast("string").alias("key"), F.to_json(F.struct(*trades.columns)).alias("value")
    )


def from_topic(raw: DataFrame, value: str = "value") -> DataFrame:
    """Topic values back to columns of the declared trade schema."""
    return raw.select(F.from_json(F.col(value).cast("string"), BRONZE_TRADES).alias("data")).select("data.*")
