"""Data-quality results as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions.labels import CLASSES
from marketloom.functions.times import ms_to_date
from marketloom.plans import gold, lake
from marketloom.plans import quality as dq
from marketloom.queries import common
from marketloom.queries.registry import query
from marketloom.schemas import CONTRACTS
from marketloom.session import scratch_path
from marketloom.sources import stand_ins

_KEEP = ["check_name", "table_name", "status", "metric_value"]


def _row(name: str, table: str, metric: str, source: str, ok: str = "m = 0", bad: str = "'failed'") -> str:
    return (
        f"SELECT '{name}' AS check_name, '{table}' AS table_name, CASE WHEN {ok} THEN 'passed' ELSE {bad} END AS status,"
        f" CAST(m AS DOUBLE) AS metric_value FROM (SELECT {metric} AS m FROM {source})"
    )


def _rows(*parts: str) -> str:
    return " UNION ALL ".join(parts)


# Undeduplicated prices as daily rows: duplicates and low balances make checks fail.
_RAW = "(SELECT coin_id, price_date, CASE WHEN market_cap_usd < 0 THEN -price_usd ELSE price_usd END AS price_usd FROM hist)"


def _raw_daily(spark, sf):
    return stand_ins.bronze_prices(spark, sf).select(
        "coin_id",
        ms_to_date(F.col("timestamp_ms")).alias("price_date"),
        F.when(F.col("market_cap_usd") < 0, -F.col("price_usd")).otherwise(F.col("price_usd")).alias("price_usd"),
    )


def _price_rules(source: str) -> list[str]:
    return [
        _row("no_duplicates", "daily_prices", "count(*)", f"(SELECT 1 FROM {source} GROUP BY coin_id, price_date HAVING count(*) > 1)"),
        _row("positive_prices", "daily_prices", "count(*) FILTER (price_usd <= 0)", source),
        _row("not_null_coin_id", "daily_prices", "count(*) FILTER (coin_id IS NULL)", source),
        _row("not_null_price_date", "daily_prices", "count(*) FILTER (price_date IS NULL)", source),
        _row("not_null_price_usd", "daily_prices", "count(*) FILTER (price_usd IS NULL)", source),
        _row("no_future_dates", "daily_prices", "count(*) FILTER (price_date > DATE '2001-08-02')", source),
    ]


@query("q5_q6_q7_q8_silver_price_checks", _rows(*_price_rules("s_prices")))
def silver_price_checks(spark, sf):
    return dq.silver_price_checks(common.prices(spark, sf), common.as_of_day()).select(*_KEEP)


@query("q5_q6_failing_price_checks", _rows(*_price_rules(_RAW)))
def failing_price_checks(spark, sf):
    return dq.silver_price_checks(_raw_daily(spark, sf), common.as_of_day()).select(*_KEEP)


_BRONZE = _rows(
        *[
            f"SELECT '{c}' AS check_name, '{t}' AS table_name, 'passed' AS status, CAST(NULL AS DOUBLE) AS metric_value"
            for t in ("historical_prices", "fear_greed_index", "realtime_prices")
            for c in ("table_exists", "schema_check")
        ],
        _row("min_row_count", "historical_prices", "count(*)", "hist", "m >= 50"),
        _row("min_row_count", "fear_greed_index", "count(*)", "sent_raw", "m >= 10"),
        _row("min_row_count", "realtime_prices", "count(*)", "trades", "m >= 100"),
        _row("data_freshness", "historical_prices", "(1706659200 - max(loaded)) // 3600", "hist", "m <= 48", "CASE WHEN m <= 72 THEN 'warning' ELSE 'failed' END"),
        _row("data_freshness", "fear_greed_index", "(1706659200 - max(loaded)) // 3600", "sent_raw", "m <= 48", "CASE WHEN m <= 72 THEN 'warning' ELSE 'failed' END"),
        _row("data_freshness", "realtime_prices", "(1706659200 - CAST(epoch(max(ingested)) AS BIGINT)) // 3600", "trades", "m <= 48", "CASE WHEN m <= 72 THEN 'warning' ELSE 'failed' END"),
)


# The daily run counts hours to its own day.
_DAILY_BRONZE = _BRONZE.replace("1706659200 -", "996710400 -")


def _bronze(spark, sf):
    return {
        "historical_prices": stand_ins.bronze_prices(spark, sf),
        "fear_greed_index": stand_ins.bronze_sentiment(spark, sf),
        "realtime_prices": stand_ins.bronze_trades(spark, sf),
    }


@query("q1_q2_q3_q4_bronze_checks", _BRONZE)
def bronze_checks(spark, sf):
    tables = _bronze(spark, sf)
    return dq.bronze_checks(spark, tables, common.as_of_time()).select(*_KEEP)


@query(
    "q9_q10_sentiment_checks",
    _rows(
        _row("value_range_0_100", "fear_greed", "count(*) FILTER (v < 0 OR v > 100)", "(SELECT fear_greed_value * 2 - 50 AS v FROM s_sent)"),
        _row("valid_classifications", "fear_greed", "count(*) FILTER (classification = 'Neutral')", "s_sent"),
    ),
)
def sentiment_checks(spark, sf):
    """Values stretched beyond the range and one class renamed, so both checks find rows."""
    rows = common.sentiment(spark, sf).withColumns(
        {
            "fear_greed_value": F.col("fear_greed_value") * 2 - 50,
            "classification": F.when(F.col("classification") == CLASSES[2], "Flat").otherwise(F.col("classification")),
        }
    )
    return dq.silver_sentiment_checks(rows).select(*_KEEP)


@query(
    "q2_q6_bar_checks",
    _rows(
        _row("has_rows", "realtime_vwap", "count(*)", "bars30", "m >= 1"),
        _row("positive_ohlc", "realtime_vwap", "count(*) FILTER (\"close\" <= 0 OR open <= 0)", "bars30"),
    ),
)
def bar_checks(spark, sf):
    return dq.silver_bar_checks(common.bars(spark, sf)).select(*_KEEP)


_GOLD = _rows(
    _row("unique_pk_coin_id", "dim_coins", "count(*) - count(DISTINCT coin_id)", "coins"),
    _row("no_date_gaps", "dim_dates", "max(date_day) - min(date_day) + 1 - count(*)", "dates", bad="'warning'"),
    _row("has_rows", "fact_market_daily", "count(*)", "fact", "m >= 1"),
    _row("fk_coin_id", "fact_market_daily", "count(*)", "(SELECT * FROM fact f WHERE NOT EXISTS (SELECT 1 FROM coins c WHERE c.coin_id = f.coin_id))"),
    _row("fk_price_date", "fact_market_daily", "count(*)", "(SELECT * FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dates d WHERE d.date_day = f.price_date))"),
)


def _gold_results(spark, sf):
    prices = common.prices(spark, sf)
    return dq.gold_checks(common.fact(spark, sf), gold.dim_coins(prices), gold.dim_dates(prices))


@query("q2_q11_q12_q13_gold_checks", _GOLD)
def gold_checks(spark, sf):
    """Gold checks over the whole fact and its dimensions."""
    return _gold_results(spark, sf).select(*_KEEP)


@query(
    "q12_missing_dates",
    """SELECT CAST(d AS DATE) AS date_day FROM (SELECT unnest(generate_series((SELECT min(date_day) FROM dates),
 (SELECT max(date_day) FROM dates), INTERVAL '1 day')) AS d) WHERE CAST(d AS DATE) NOT IN (SELECT date_day FROM dates)""",
)
def missing_dates(spark, sf):
    return dq.missing_dates(gold.dim_dates(common.prices(spark, sf)))


@query(
    "a10_q14_layer_summary",
    f"""SELECT layer, count(*) AS total, count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'failed') AS failed,
 count(*) FILTER (status = 'warning') AS warnings, CAST(0 AS BIGINT) AS errors,
 round(count(*) FILTER (status = 'passed') / count(*) * 100, 1) AS pass_rate FROM
 (SELECT 'gold' AS layer, * FROM ({_GOLD}) UNION ALL SELECT 'silver', * FROM ({_rows(*_price_rules(_RAW))})) GROUP BY 1""",
)
def layer_summary(spark, sf):
    silver = dq.silver_price_checks(_raw_daily(spark, sf), common.as_of_day())
    return dq.summary(_gold_results(spark, sf).unionByName(silver))


@query(
    "a11_v9_table_reports",
    f"""SELECT table_name, round(count(*) FILTER (status = 'passed') / count(*), 3) AS success_rate, count(*) AS total_expectations,
 count(*) FILTER (status = 'passed') AS successful_expectations FROM
 ({_GOLD} UNION ALL {_rows(*_price_rules(_RAW))}) GROUP BY 1""",
)
def table_reports(spark, sf):
    silver = dq.silver_price_checks(_raw_daily(spark, sf), common.as_of_day())
    return dq.table_reports(_gold_results(spark, sf).unionByName(silver))


_SUITE = {
    "bronze": f"""SELECT * FROM (VALUES (0, 'exist', 'coin_id', 1.0, true), (1, 'exist', 'price_usd', 1.0, true),
 (2, 'not_null', 'coin_id', 1.0, true), (3, 'not_null', 'price_usd', 1.0, true)) v(position, expectation, column_name, met_share, success)
 UNION ALL SELECT 4, 'between', 'price_usd', round(s, 6), s >= 1 FROM (SELECT count(*) FILTER (price_usd >= 0) / count(price_usd) AS s FROM {_RAW})"""
}


@query("q15_bronze_suite", _SUITE["bronze"])
def bronze_suite(spark, sf):
    rows = dq.run_suite(_raw_daily(spark, sf), dq.SUITES["bronze_prices_suite"], "historical_prices")
    return common.rounded(rows, 6, "met_share").drop("table_name")


@query(
    "q15_silver_suite",
    """SELECT * FROM (VALUES (0, 'exist', 'coin_id', 1.0, true), (1, 'exist', 'price_date', 1.0, true),
 (2, 'not_null', 'coin_id', 1.0, true), (3, 'not_null', 'price_usd', 1.0, true), (5, 'between', 'price_usd', 1.0, true))
 v(position, expectation, column_name, met_share, success)
 UNION ALL SELECT 4, 'unique', 'coin_id', round(s, 6), s >= 0.01 FROM
 (SELECT coalesce(sum(CASE WHEN n = 1 THEN 1 END), 0) / sum(n) AS s FROM (SELECT coin_id, count(*) AS n FROM s_prices GROUP BY 1))""",
)
def silver_suite(spark, sf):
    rows = dq.run_suite(common.prices(spark, sf), dq.SUITES["silver_prices_suite"], "daily_prices")
    return common.rounded(rows, 6, "met_share").drop("table_name")


@query(
    "q15_suite_status",
    f"""SELECT table_name, round(met / total, 3) AS success_rate, CASE WHEN met / total > 0.8 THEN 'PASS' ELSE 'FAIL' END AS status FROM
 (SELECT 'historical_prices' AS table_name, 5 AS total, 2 + CAST(count(coin_id) = count(*) AS INTEGER)
   + CAST(count(price_usd) = count(*) AS INTEGER) + CAST(count(*) FILTER (price_usd < 0) = 0 AS INTEGER) AS met FROM {_RAW}
  UNION ALL SELECT 'daily_prices', 6, 2 + CAST(count(coin_id) = count(*) AS INTEGER) + CAST(count(price_usd) = count(*) AS INTEGER)
   + CAST(count(*) FILTER (price_usd < 0) = 0 AS INTEGER)
   + (SELECT CAST(coalesce(sum(CASE WHEN n = 1 THEN 1 END), 0) / sum(n) >= 0.01 AS INTEGER) FROM
      (SELECT count(*) AS n FROM s_prices GROUP BY coin_id)) FROM s_prices
  UNION ALL SELECT 'fact_market_daily', 3, CAST(count(coin_id) = count(*) AS INTEGER) + CAST(count(price_usd) = count(*) AS INTEGER)
   + CAST(count(*) FILTER (price_usd < 0.00000001) = 0 AS INTEGER) FROM fact)""",
)
def suite_status(spark, sf):
    parts = [
        dq.run_suite(_raw_daily(spark, sf), dq.SUITES["bronze_prices_suite"], "historical_prices"),
        dq.run_suite(common.prices(spark, sf), dq.SUITES["silver_prices_suite"], "daily_prices"),
        dq.run_suite(common.fact(spark, sf), dq.SUITES["gold_market_suite"], "fact_market_daily"),
    ]
    return dq.suite_status(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(
    "q16_generic_tests",
    _rows(
        *[_row(f"not_null_{c}", "fact_market_daily", f"count(*) FILTER ({c} IS NULL)", "fact") for c in ("coin_id", "price_date", "price_usd")],
        _row("unique_pk_coin_id", "dim_coins", "count(*) - count(DISTINCT coin_id)", "coins"),
        _row("not_null_coin_id", "dim_coins", "count(*) FILTER (coin_id IS NULL)", "coins"),
        _row("unique_pk_date_day", "dim_dates", "count(*) - count(DISTINCT date_day)", "dates"),
        _row("not_null_date_day", "dim_dates", "count(*) FILTER (date_day IS NULL)", "dates"),
    ),
)
def generic_tests(spark, sf):
    prices = common.prices(spark, sf)
    return dq.generic_tests(common.fact(spark, sf), gold.dim_coins(prices), gold.dim_dates(prices)).select(*_KEEP)


@query("q16_non_positive_rows", f"SELECT coin_id, price_date, price_usd FROM {_RAW} WHERE price_usd <= 0")
def non_positive(spark, sf):
    return dq.non_positive_prices(_raw_daily(spark, sf))


@query("q8_q16_future_rows", "SELECT coin_id, price_date, price_usd FROM fact WHERE price_date > DATE '2001-01-01'")
def future_rows(spark, sf):
    return dq.future_dates(common.fact(spark, sf), F.lit("2001-01-01"))


@query(
    "q17_contract_silver",
    _rows(
        *[_row(f"not_null_{c}", "silver_daily_prices", f"count(*) FILTER ({c} IS NULL)", "s_prices") for c in ("coin_id", "price_date", "price_usd")],
        _row("minimum_price_usd", "silver_daily_prices", "count(*) FILTER (price_usd < 0)", "s_prices"),
        _row("freshness", "silver_daily_prices", "CAST(epoch(TIMESTAMP '2001-08-02') - epoch(max(price_date)) AS BIGINT)", "s_prices", "m <= 86400"),
        _row("no_duplicates", "silver_daily_prices", "count(*)", "(SELECT 1 FROM s_prices GROUP BY coin_id, price_date HAVING count(*) > 1)"),
        "SELECT 'schema' AS check_name, 'silver_daily_prices' AS table_name, 'failed' AS status, CAST(NULL AS DOUBLE) AS metric_value",
    ),
)
def contract_silver(spark, sf):
    newest = F.col("price_date").cast("timestamp")
    return dq.contract_checks(
        common.prices(spark, sf), CONTRACTS["silver_daily_prices"], "silver_daily_prices", newest,
        common.as_of_day().cast("timestamp"),
    ).select(*_KEEP)


_THIN = """SELECT h AS hour, coalesce(n, 0) AS records FROM (SELECT unnest(generate_series((SELECT min(price_hour) FROM hourly),
 (SELECT max(price_hour) FROM hourly), INTERVAL '1 hour')) AS h) LEFT JOIN
 (SELECT price_hour, CAST(sum(trade_count) AS BIGINT) AS n FROM hourly GROUP BY 1) ON h = price_hour
 WHERE coalesce(n, 0) < 1000"""


@query(
    "q17_contract_bronze",
    _rows(
        *[_row(f"not_null_{c}", "bronze_realtime_prices", f"count(*) FILTER ({c} IS NULL)", "trades") for c in ("coin_id", "price_usd", "trade_time_ms")],
        _row("minimum_price_usd", "bronze_realtime_prices", "count(*) FILTER (price_usd < 0)", "trades"),
        _row("freshness", "bronze_realtime_prices", "1706659200 - CAST(floor(max(trade_time_ms) / 1000) AS BIGINT)", "trades", "m <= 300"),
        _row("records_per_hour", "bronze_realtime_prices", "count(*)", f"({_THIN})"),
        "SELECT 'schema' AS check_name, 'bronze_realtime_prices' AS table_name, 'passed' AS status, CAST(NULL AS DOUBLE) AS metric_value",
    ),
)
def contract_bronze(spark, sf):
    return dq.contract_checks(
        stand_ins.bronze_trades(spark, sf), CONTRACTS["bronze_realtime_prices"], "bronze_realtime_prices",
        F.timestamp_millis("trade_time_ms"), common.as_of_time(),
    ).select(*_KEEP)


@query(
    "q12_date_gaps",
    """SELECT CAST(d + 1 AS DATE) AS first_missing, CAST(n - 1 AS DATE) AS last_missing, CAST(n - d - 1 AS BIGINT) AS missing FROM
 (SELECT d, lead(d) OVER (ORDER BY d) AS n FROM (SELECT DISTINCT price_date AS d FROM s_prices WHERE day(price_date) % 5 < 3
  UNION ALL SELECT DATE '9999-12-30')) WHERE n > d + 1""",
)
def date_gaps(spark, sf):
    """Runs of missing days; one date of the year 9999 costs one row."""
    days = common.prices(spark, sf).filter(F.dayofmonth("price_date") % 5 < 3).select("price_date")
    wrong = spark.range(1).select(F.lit("9999-12-30").cast("date").alias("price_date"))
    return dq.gaps(days.unionByName(wrong), "price_date", "day").drop("unit")


@query("q17_thin_hours", _THIN)
def thin_hours(spark, sf):
    contract = CONTRACTS["bronze_realtime_prices"]
    return dq.thin_hours(stand_ins.bronze_trades(spark, sf), contract["min_records_per_hour"])


@query(
    "q18_v11_ingestion_lag",
    """SELECT 'bronze' AS layer, round((1706659200000 - max(trade_time_ms)) / 1000, 1) AS lag_seconds,
 CASE WHEN (1706659200000 - max(trade_time_ms)) / 1000 < 300 THEN 'OK' ELSE 'DELAYED' END AS status FROM trades
 UNION ALL SELECT 'silver', round((1706659200000 - epoch_ms(max(window_end))) / 1000, 1),
 CASE WHEN (1706659200000 - epoch_ms(max(window_end))) / 1000 < 300 THEN 'OK' ELSE 'DELAYED' END FROM bars30""",
)
def ingestion_lag(spark, sf):
    tables = {
        "bronze": (stand_ins.bronze_trades(spark, sf), F.timestamp_millis("trade_time_ms")),
        "silver": (common.bars(spark, sf), F.col("window_end")),
    }
    return dq.ingestion_lag(tables, common.as_of_time()).drop("latest")


@query(
    "q14_s23_daily_run_checks",
    _rows(
        *_price_rules("s_prices"),
        _row("value_range_0_100", "fear_greed", "count(*) FILTER (fear_greed_value NOT BETWEEN 0 AND 100)", "s_sent"),
        _row("valid_classifications", "fear_greed", "count(*) FILTER (classification IS NULL)", "s_sent"),
        _row("unique_pk_coin_id", "dim_coins", "count(*) - count(DISTINCT coin_id)", "coins"),
        _row("no_date_gaps", "dim_dates", "max(date_day) - min(date_day) + 1 - count(*)", "dates", bad="'warning'"),
        _row("has_rows", "fact_market_daily", "count(*)", "fact", "m >= 1"),
        _row("fk_coin_id", "fact_market_daily", "count(*)", "(SELECT * FROM fact WHERE coin_id NOT IN (SELECT coin_id FROM coins))"),
        _row("fk_price_date", "fact_market_daily", "count(*)", "(SELECT * FROM fact WHERE price_date NOT IN (SELECT date_day FROM dates))"),
        _row("has_rows", "realtime_vwap", "count(*)", "bars30", "m >= 1"),
        _row("positive_ohlc", "realtime_vwap", "count(*) FILTER (\"close\" <= 0 OR open <= 0)", "bars30"),
        f"SELECT * FROM ({_DAILY_BRONZE}) WHERE table_name <> 'realtime_prices'",
        "SELECT 'table_exists', 'realtime_prices', 'failed', NULL",
    ),
)
def daily_run_checks(spark, sf):
    """The whole daily run into an empty lake, two loads, then its checks."""
    root = scratch_path(spark, "lake")
    prices, sentiment = stand_ins.bronze_prices(spark, sf), stand_ins.bronze_sentiment(spark, sf)
    as_of = common.as_of_day().cast("timestamp")
    early = F.col("timestamp_ms") < F.unix_millis(F.lit("2001-01-01").cast("timestamp"))
    lake.load(spark, root, prices.filter(early), sentiment, None, as_of)
    trades = scratch_path(spark, "bronze")
    stand_ins.bronze_trades(spark, sf).write.parquet(trades)
    lake.load(spark, root, prices, sentiment, trades, as_of)
    bars = common.silver_bars(spark, sf)
    for _ in range(2):  # a repeat replaces the results of the day
        lake.check(spark, root, as_of, {**_bronze(spark, sf), "realtime_prices": None}, bars)
    return spark.read.parquet(f"{root}/{lake.CHECKS}").select(*_KEEP)
