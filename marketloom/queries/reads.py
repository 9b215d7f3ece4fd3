"""Read queries and dashboard tables over the lake."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.plans import dashboard, gold, serving
from marketloom.queries import common
from marketloom.queries.registry import query
from marketloom.sources import stand_ins

_PRICE_FIELDS = """coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, price_change_pct_1d, moving_avg_7d,
 moving_avg_30d, ma30_signal"""


@query(
    "v1_prices",
    f"""SELECT * FROM (SELECT {_PRICE_FIELDS} FROM fact WHERE coin_id = '1-URGENT' AND price_date BETWEEN DATE '2001-08-02' - 30
 AND DATE '2001-08-02' ORDER BY price_date DESC LIMIT 100) ORDER BY price_date""",
)
def prices(spark, sf):
    return serving.prices(common.fact(spark, sf), common.prices(spark, sf), "1-URGENT", common.as_of_day())


@query(
    "v1_prices_from_silver",
    """SELECT * FROM (SELECT coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd FROM s_prices WHERE coin_id = '2-HIGH'
 AND price_date BETWEEN DATE '1998-01-01' AND DATE '2001-08-02' ORDER BY price_date DESC LIMIT 50) ORDER BY price_date""",
)
def prices_from_silver(spark, sf):
    start = F.lit("1998-01-01").cast("date")
    return serving.prices(None, common.prices(spark, sf), "2-HIGH", common.as_of_day(), start, 50)


_OVERVIEW = """(SELECT coin_id, price_usd AS current_price, price_change_pct_1d AS price_change_24h_pct, market_cap_usd, volume_24h_usd
 FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY price_date DESC) AS rn FROM fact
 WHERE price_date >= DATE '2001-08-02' - 7) WHERE rn = 1)"""


@query("v2_market_overview", f"SELECT * FROM {_OVERVIEW}")
def market_overview(spark, sf):
    return serving.market_overview(common.fact(spark, sf), common.as_of_day())


@query(
    "p25_overview_display",
    f"""SELECT coin_id AS asset, coalesce(current_price, 0) AS price, coalesce(price_change_24h_pct, 0) AS change_24h_pct,
 coalesce(market_cap_usd, 0) AS market_cap, coalesce(volume_24h_usd, 0) AS volume_24h FROM {_OVERVIEW}""",
)
def overview_display(spark, sf):
    return dashboard.display_table(serving.market_overview(common.fact(spark, sf), common.as_of_day()))


@query(
    "j8_comparative_metrics",
    f"""SELECT coin_id, coalesce(current_price, 0) AS current_price, coalesce(price_change_24h_pct, 0) AS price_change_24h_pct,
 coalesce(market_cap_usd, 0) AS market_cap_usd, coalesce(volume_24h_usd, 0) AS volume_24h_usd
 FROM {_OVERVIEW} WHERE coin_id IN ('1-URGENT', '5-LOW')""",
)
def comparative_metrics(spark, sf):
    overview = serving.market_overview(common.fact(spark, sf), common.as_of_day())
    return dashboard.comparative_metrics(overview, "1-URGENT", "5-LOW")


@query(
    "d3_d4_signal_matrix",
    f"""SELECT upper(coin_id) AS asset, current_price, c AS change_pct, CASE WHEN c < -5 THEN 'OVERSOLD' WHEN c < -2 THEN 'WEAK'
 WHEN c > 5 THEN 'OVERBOUGHT' WHEN c > 2 THEN 'STRONG' ELSE 'NEUTRAL' END AS technical, v AS sentiment,
 CASE WHEN v < 30 AND c < -2 THEN 'BUY' WHEN v > 70 AND c > 2 THEN 'SELL' ELSE 'HOLD' END AS combined
 FROM (SELECT *, coalesce(price_change_24h_pct, 0) AS c FROM {_OVERVIEW}),
 (SELECT fear_greed_value AS v FROM s_sent ORDER BY index_date DESC LIMIT 1)""",
)
def signal_matrix(spark, sf):
    value = common.sentiment(spark, sf).agg(F.max_by("fear_greed_value", "index_date").alias("v")).scalar()
    return dashboard.signal_matrix(serving.market_overview(common.fact(spark, sf), common.as_of_day()), value)


@query(
    "v3_k3_latest_sentiment",
    """SELECT value, classification, "timestamp" FROM sent_raw ORDER BY "timestamp" DESC, loaded DESC, value DESC LIMIT 1""",
)
def latest_sentiment(spark, sf):
    return serving.latest_sentiment(stand_ins.bronze_sentiment(spark, sf))


@query(
    "v4_p24_sentiment_history",
    """SELECT value, classification, "timestamp", strftime(index_date, '%Y-%m-%d') AS date_str FROM
 (SELECT *, row_number() OVER (PARTITION BY index_date ORDER BY "timestamp" DESC, loaded DESC, value DESC) AS rn FROM sent_raw)
 WHERE rn = 1 ORDER BY date_str""",
)
def sentiment_history(spark, sf):
    return serving.sentiment_history(stand_ins.bronze_sentiment(spark, sf))


@query(
    "d5_sentiment_bands",
    """SELECT value, band, count(*) AS n FROM (SELECT value, classification AS band FROM
 (SELECT *, row_number() OVER (PARTITION BY index_date ORDER BY "timestamp" DESC, loaded DESC, value DESC) AS rn FROM sent_raw)
 WHERE rn = 1) GROUP BY 1, 2""",
)
def sentiment_bands(spark, sf):
    history = serving.sentiment_history(stand_ins.bronze_sentiment(spark, sf))
    return dashboard.sentiment_bands(history).groupBy("value", "band").agg(F.count(F.lit(1)).alias("n"))


_OHLC = 'window_start AS "timestamp", open, high, low, "close", total_volume AS volume, is_anomaly'


@query(
    "v5_realtime_ohlc",
    f"""SELECT {_OHLC} FROM bars30 WHERE coin_id = 'click' AND (window_start >= TIMESTAMP '2024-01-30 20:00:00'
 OR (SELECT max(window_start) FROM bars30 WHERE coin_id = 'click') < TIMESTAMP '2024-01-30 20:00:00') ORDER BY 1""",
)
def realtime_ohlc(spark, sf):
    return serving.realtime_ohlc(common.bars(spark, sf), "click", common.as_of_time())


@query("v5_realtime_ohlc_fallback", f"SELECT {_OHLC} FROM bars30 WHERE coin_id = 'view' ORDER BY 1")
def realtime_ohlc_fallback(spark, sf):
    """Nothing in the last hours before a later date: all bars are returned."""
    return serving.realtime_ohlc(common.bars(spark, sf), "view", F.lit("2024-03-01").cast("timestamp"))


@query(
    "v10_s24_system_alerts",
    """SELECT event_id AS position, CAST(epoch_us(ts) // 1000 AS DOUBLE) / 1000 AS "timestamp", event_type AS level, 'dag' AS dag_id,
 'task' AS task_id, props AS message FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 20)
 WHERE user_id % 3 <> 0 ORDER BY event_id DESC""",
)
def system_alerts(spark, sf):
    """Events as alert log entries, a third of them malformed."""
    alert = F.to_json(
        F.struct(
            (F.unix_millis(F.col("ts").cast("timestamp")) / 1000).alias("timestamp"),
            F.col("event_type").alias("level"),
            F.lit("dag").alias("dag_id"),
            F.lit("task").alias("task_id"),
            F.col("props").alias("message"),
        )
    )
    value = F.when(F.col("user_id") % 3 == 0, F.lit("{broken")).otherwise(alert)
    raw = stand_ins.table(spark, sf, "events").select(F.col("event_id").alias("position"), value.alias("value"))
    return serving.system_alerts(raw)


@query(
    "v12_k1_coin_list",
    """SELECT coin_id, first_tracked_date, last_tracked_date, total_days_tracked, all_time_low, all_time_high, avg_price,
 avg_daily_volume, price_range_pct FROM coins ORDER BY avg_price DESC""",
)
def coin_list(spark, sf):
    return serving.coin_list(gold.dim_coins(common.prices(spark, sf)))


@query(
    "v12_a5_lake_totals",
    """SELECT (SELECT count(*) FROM coins) AS total_coins, min(price_date) AS date_range_start, max(price_date) AS date_range_end,
 count(*) AS total_fact_rows, (SELECT arg_max(fear_greed_value, index_date) FROM s_sent) AS latest_fear_greed,
 (SELECT arg_max(classification, index_date) FROM s_sent) AS latest_sentiment FROM fact""",
)
def lake_totals(spark, sf):
    prices_ = common.prices(spark, sf)
    return serving.lake_totals(gold.dim_coins(prices_), common.fact(spark, sf), common.sentiment(spark, sf))
