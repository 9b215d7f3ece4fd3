"""Checks must fail on bad rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.plans import quality as dq
from marketloom.schemas import CONTRACTS

D = dt.date(2024, 1, 1)


def status(df):
    return {r["check_name"]: (r["status"], r["metric_value"]) for r in df.collect()}


def prices(spark, data):
    return spark.createDataFrame(data, "coin_id string, price_date date, price_usd double")


def test_good_prices_pass(spark):
    good = prices(spark, [("a", D, 1.0), ("b", D, 2.0)])
    results = dq.silver_price_checks(good, F.lit(D))
    assert {s for s, _ in status(results).values()} == {"passed"}
    dq.assert_no_failures(results)


def test_bad_prices_fail(spark):
    bad = prices(spark, [("a", D, 1.0), ("a", D, -1.0), (None, D, 2.0), ("c", D + dt.timedelta(9), None)])
    results = dq.silver_price_checks(bad, F.lit(D))
    assert status(results) == {
        "no_duplicates": ("failed", 1.0),
        "positive_prices": ("failed", 1.0),
        "not_null_coin_id": ("failed", 1.0),
        "not_null_price_date": ("passed", 0.0),
        "not_null_price_usd": ("failed", 1.0),
        "no_future_dates": ("failed", 1.0),
    }
    with pytest.raises(RuntimeError, match="5 checks failed"):
        dq.assert_no_failures(results)
    summary = dq.summary(results).first()
    assert (summary.total, summary.passed, summary.failed, summary.pass_rate) == (6, 1, 5, 16.7)


def test_sentiment_rules(spark):
    bad = spark.createDataFrame([(-1, "Fear"), (101, "Odd"), (50, None)], "fear_greed_value int, classification string")
    assert status(dq.silver_sentiment_checks(bad)) == {
        "value_range_0_100": ("failed", 2.0),
        "valid_classifications": ("failed", 1.0),
    }


@pytest.mark.parametrize("hours,want", [(48, "passed"), (49, "warning"), (72, "warning"), (73, "failed"), (None, "warning")])
def test_freshness_levels(spark, hours, want):
    now = dt.datetime(2024, 1, 10)
    ts = None if hours is None else now - dt.timedelta(hours=hours)
    df = spark.createDataFrame([(ts,)], "t timestamp")
    got = status(dq.run_checks(df, "bronze", "t", [dq.freshness(F.col("t"), F.lit(now))]))
    assert got["data_freshness"][0] == want


def test_missing_table_and_columns(spark):
    df = spark.createDataFrame([("a", 1.0)], "coin_id string, price_usd double")
    exists = dq.table_exists(spark, None, "bronze", "historical_prices").first()
    assert exists.status == "failed"
    schema = dq.schema_check(spark, df, "bronze", "historical_prices", ["coin_id", "timestamp_ms"]).first()
    assert (schema.status, schema.message) == ("failed", "missing: ['timestamp_ms']")


def test_gold_finds_orphans_and_gaps(spark):
    fact = prices(spark, [("a", D, 1.0), ("x", D, 1.0), (None, D, 1.0), ("a", D + dt.timedelta(7), 1.0)])
    coins = spark.createDataFrame([("a",), ("a",)], "coin_id string")
    dates = spark.createDataFrame([(D,), (D + dt.timedelta(3),)], "date_day date")
    got = status(dq.gold_checks(fact, coins, dates))
    assert got["unique_pk_coin_id"] == ("failed", 1.0)
    assert got["no_date_gaps"] == ("warning", 2.0)
    assert got["fk_coin_id"] == ("failed", 2.0)
    assert got["fk_price_date"] == ("failed", 1.0)
    assert [r.date_day for r in dq.missing_dates(dates).orderBy("date_day").collect()] == [
        D + dt.timedelta(1), D + dt.timedelta(2),
    ]


def test_suites(spark):
    df = prices(spark, [("a", D, 1.0), ("a", D, -2.0), ("b", D, None)])
    got = {r["position"]: (r["expectation"], r["success"]) for r in dq.run_suite(df, dq.SUITES["silver_prices_suite"], "t").collect()}
    assert got == {
        0: ("exist", True), 1: ("exist", True), 2: ("not_null", True), 3: ("not_null", False),
        4: ("unique", True), 5: ("between", False),
    }
    report = dq.suite_status(dq.run_suite(df, dq.SUITES["silver_prices_suite"], "t")).first()
    assert (report.success_rate, report.status) == (0.667, "FAIL")
    strange = df.drop("price_usd")
    types = [r["expectation"] for r in dq.run_suite(strange, dq.SUITES["gold_market_suite"], "t").collect()]
    assert types == ["not_null"], "expectations on a missing column cannot run"


def test_contracts(spark):
    contract = CONTRACTS["silver_daily_prices"]
    df = prices(spark, [("a", D, -1.0), ("a", D, 2.0)])
    drift = dq.schema_drift(df, contract)
    assert drift == ["market_cap_usd: missing", "volume_24h_usd: missing", "_processed_at: missing"]
    as_of = F.lit(dt.datetime(2024, 1, 3)).cast("timestamp")
    got = status(dq.contract_checks(df, contract, "t", F.col("price_date").cast("timestamp"), as_of))
    assert got["minimum_price_usd"] == ("failed", 1.0)
    assert got["freshness"] == ("failed", 172800.0)
    assert got["no_duplicates"] == ("failed", 1.0)


def test_thin_hours_include_empty_ones(spark, rows):
    df = spark.createDataFrame([(0,), (1,), (2 * 3600000,)], "trade_time_ms long")
    got = [(h.hour, n) for h, n in rows(dq.thin_hours(df, 2))]
    assert got == [(1, 0), (2, 1)]


def test_empty_layer_lag(spark):
    empty = spark.createDataFrame([], "t timestamp")
    got = dq.ingestion_lag({"bronze": (empty, F.col("t"))}, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")).first()
    assert (got.status, got.lag_seconds) == ("EMPTY", None)


def test_missing_and_broken_tables_become_rows(spark, rows):
    bad = spark.createDataFrame([("x",)], "price_usd string")
    checks = lambda t: dq.run_checks(t, "silver", "t", [dq.violations("p", F.col("price_usd").cast("double") <= 0, "p")])
    got = [
        dq.guarded(spark, "silver", "gone", None, checks),
        dq.guarded(spark, "silver", "broken", bad, checks),
        dq.guarded(spark, "silver", "other", bad.withColumnRenamed("price_usd", "q"), checks),
    ]
    assert [rows(g, "table_name", "check_name", "status") for g in got] == [
        [("gone", "table_exists", "failed")], [("broken", "run_checks", "error")], [("other", "run_checks", "error")],
    ]
