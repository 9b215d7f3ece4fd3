"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from marketloom import queries as registered
from tools.check_oracle import table

SAMPLE = [
    "m10_fact_market_daily",
    "m1_w1_silver_daily_prices",
    "m2_w1_silver_sentiment",
    "m8_a1_p9_dim_coins",
    "m9_a7_p13_p14_p15_dim_dates",
    "m12_a8_market_ohlc",
    "m13_vwap_bars_1h",
    "m11_w8_w9_fact_price_hourly",
    "s1_s2_j5_normalise_trades",
    "s8_j6_price_payload_rows",
    "s10_sentiment_payload_rows",
    "w3_w5_rolling_chunked",
    "f13_p23_feature_matrix",
    "l8_l10_trend_forecast",
    "l11_a13_v7_accuracy_report",
    "q5_q6_failing_price_checks",
    "a11_v9_table_reports",
    "v2_market_overview",
    "v5_realtime_ohlc",
    "d3_d4_signal_matrix",
    "t2_t3_t4_t5_t6_t7_stream_bars_append",
    "s19_lagging_asset",
    "s19_restated_day",
    "s19_changed_sentiment_day",
    "s19_equal_load_second",
    "t8_stream_scoring",
    "l4_time_split",
    "d2_smoothed_predictions",
    "f14_l15_training_samples",
    "q17_contract_bronze",
]


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registered.queries()) - set(registered.oracle_sql()) == {"l1_l2_l3_l5_l14_train_voters"}


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    cursor = con.execute(entry.oracle_sql()[name])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want
