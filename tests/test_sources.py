"""Parsing and validation cases of the raw payloads."""

import json

import pytest
from pyspark.sql import functions as F

from marketloom.schemas import BRONZE_PRICES, BRONZE_SENTIMENT, BRONZE_TRADES, SILVER_BARS, SILVER_PRICES
from marketloom.sources import ingest, payloads, scan, trades

TRADE = {
    "e": "aggTrade", "s": "SOLUSDT", "p": "151.75", "q": "4.2", "T": 1712345678901, "E": 1712345679050, "m": True,
}


def now():
    return F.lit("2024-04-06T08:30:00+00:00")


def messages(spark, *docs):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_fields_of_a_trade(spark):
    row = trades.trades_from_messages(messages(spark, TRADE), now()).first()
    assert (row.coin_id, row.symbol, row.is_buyer_maker) == ("solana", "SOLUSDT", True)
    assert (row.price_usd, row.quantity) == (151.75, 4.2)
    assert (row.trade_time_ms, row.event_time_ms) == (1712345678901, 1712345679050)
    assert row.ingested_at == "2024-04-06T08:30:00+00:00"


@pytest.mark.parametrize("symbol, asset", [("DOTUSDT", "polkadot"), ("ABCEUR", "abceur")])
def test_assets_of_symbols(spark, symbol, asset):
    assert trades.trades_from_messages(messages(spark, {**TRADE, "s": symbol}), now()).first().coin_id == asset


def test_every_pair_has_its_own_asset():
    assets = list(trades.PAIR_TO_ASSET.values())
    assert len(set(assets)) == len(assets) == 8 and all(p.upper().endswith("USDT") for p in trades.PAIR_TO_ASSET)


@pytest.mark.parametrize("text", ["0.00071", "1e3", "42"])
def test_prices_arrive_as_strings(spark, text):
    assert trades.trades_from_messages(messages(spark, {**TRADE, "p": text}), now()).first().price_usd == float(text)


def test_empty_message_takes_defaults(spark):
    row = trades.normalise(trades.parse_messages(messages(spark, "{}")), now()).first()
    assert (row.coin_id, row.price_usd, row.quantity, row.trade_time_ms, row.is_buyer_maker) == ("", 0.0, 0.0, 0, False)


def test_envelope_and_rejects(spark, rows):
    raw = messages(
        spark,
        {"stream": "x", "data": TRADE},
        {**TRADE, "e": "trade"},
        {**TRADE, "p": "n/a"},
        "<not json",
        {**TRADE, "T": "soon"},
    )
    assert trades.trades_from_messages(raw, now()).count() == 1
    assert [r[0] for r in rows(trades.quarantined(raw), "problem")] == ["ill_typed", "ill_typed", "malformed"]


def test_topic_round_trip(spark, rows):
    original = trades.trades_from_messages(messages(spark, TRADE, {**TRADE, "s": "ETHUSDT"}), now())
    keyed = trades.to_topic(original)
    assert {r["key"] for r in keyed.collect()} == {"solana", "ethereum"}
    assert rows(trades.from_topic(keyed)) == rows(original)


HOURS = [1712300400000 + 3600000 * i for i in range(5)]


def test_price_history_rows(spark, rows):
    doc = {
        "prices": [[t, 3.5 - i / 4] for i, t in enumerate(HOURS[:4])],
        "market_caps": [[HOURS[0], 800.0]],
        "total_volumes": [[t, 7.0 * i] for i, t in enumerate(HOURS)],
    }
    raw = spark.createDataFrame([("cardano", json.dumps(doc))], "coin_id string, value string")
    got = rows(payloads.price_history_rows(raw))
    want = [(3.5, 800.0, 0.0), (3.25, None, 7.0), (3.0, None, 14.0), (2.75, None, 21.0)]
    assert got == [("cardano", t, *w) for t, w in zip(HOURS, want)]
    bare = spark.createDataFrame([("a", json.dumps({"prices": doc["prices"]}))], "coin_id string, value string")
    assert [r[3:] for r in rows(payloads.price_history_rows(bare))] == [(None, None)] * 4


def test_training_rows_of_short_payloads_are_left_out_by_one_parse(spark, rows):
    docs = [("a", {"prices": [[t, 1.0] for t in HOURS]}), ("b", {"prices": [[t, 2.0] for t in HOURS[:2]]}), ("c", {})]
    raw = spark.createDataFrame([(c, json.dumps(d)) for c, d in docs], "coin_id string, value string")
    made = payloads.hourly_training_rows(raw, min_points=3)
    assert rows(made, "coin_id", "volume_usd") == [("a", 0.0)] * 5
    assert made._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_sentiment_rows(spark, rows):
    readings = [("61", "Greed", "1712275200"), ("8", "Extreme Fear", "1712361600"), ("n/a", "Neutral", "x")]
    fields = ("value", "value_classification", "timestamp")
    doc = {"data": [dict(zip(fields, r), time_until_update="900") for r in readings]}
    got = rows(payloads.sentiment_rows(messages(spark, doc)))
    assert got == [(61, "Greed", 1712275200, "900"), (8, "Extreme Fear", 1712361600, "900"), (None, "Neutral", None, "900")]


def test_price_validation(spark):
    data = [("cardano", 9, 0.4), ("cardano", 9, -0.4), (None, 9, 0.4), ("solana", 9, 151.0), ("", 9, 1.0), ("solana", 0, 1.0), ("solana", 9, None)]
    df = spark.createDataFrame(data, "coin_id string, timestamp_ms long, price_usd double")
    kept = ingest.ingest(df, ingest.valid_price(), "history", now()).collect()
    assert sorted(r.price_usd for r in kept) == [0.4, 151.0]
    assert {(r["_source"], r["_ingested_at"]) for r in kept} == {("history", "2024-04-06T08:30:00+00:00")}
    assert tuple(ingest.ingest_counts(df, ingest.valid_price()).first()) == (7, 2, 5)


def test_sentiment_validation(spark):
    df = spark.createDataFrame([(v, 8) for v in (-7, 0, 33, 100, 140, None)] + [(61, 0)], "value int, timestamp long")
    assert sorted(r.value for r in df.filter(ingest.valid_sentiment()).collect()) == [0, 33, 100]


def test_records_without_any_value_are_dropped(spark):
    df = spark.createDataFrame([(None, None), ("x", None), (None, 4)], "k string, v int")
    assert df.filter(ingest.not_empty_record(df)).count() == 2


def test_conform_rejects_null_in_required_column(spark):
    bad = spark.createDataFrame(
        [(None, 1, 1.0, None, None, "x", "y")],
        "coin_id string, timestamp_ms int, price_usd double, market_cap_usd double, volume_24h_usd double,"
        " _ingested_at string, _source string",
    )
    with pytest.raises(Exception, match="NULL in required column coin_id"):
        ingest.conform(bad, BRONZE_PRICES).collect()
    fixed = ingest.conform(bad.fillna({"coin_id": "a"}), BRONZE_PRICES)
    assert dict(fixed.dtypes)["timestamp_ms"] == "bigint"


def test_scan_takes_known_columns_and_pushes_the_filter(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    got = scan.scan(orders, ["o_orderkey", "nope"], F.col("o_totalprice") > 1000)
    assert got.columns == ["o_orderkey"]
    plan = got._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThan(o_totalprice,1000" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert scan.read_optional(spark, f"{sf}/nothing.parquet") is None


def test_schemas():
    assert BRONZE_TRADES.fieldNames()[:3] == ["coin_id", "symbol", "price_usd"]
    assert not BRONZE_PRICES["price_usd"].nullable and BRONZE_PRICES["market_cap_usd"].nullable
    assert not BRONZE_SENTIMENT["value"].nullable
    assert SILVER_PRICES.fieldNames() == [
        "coin_id", "price_date", "price_usd", "market_cap_usd", "volume_24h_usd", "_processed_at",
    ]
    assert len(SILVER_BARS.fieldNames()) == 13
