"""Silver and gold models over daily prices and sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import labels, times
from marketloom.operators import latest
from marketloom.operators.match import orphans
from marketloom.operators.merge import merged, newer_than
from marketloom.operators.series import rolling
from marketloom.plans import dashboard, gold, silver
from marketloom.queries import common
from marketloom.queries.registry import query
from marketloom.sources import stand_ins



@query("m10_fact_market_daily", "SELECT * FROM fact")
def fact_market_daily(spark: SparkSession, sf: str) -> DataFrame:
    return common.fact(spark, sf)


@query(
    "m10_p11_fact_binary_signal",
    """SELECT d.coin_id, d.price_date, d.price_usd, d.market_cap_usd, d.volume_24h_usd, d.price_change_pct_1d,
 round(d.moving_avg_7d, 4) AS moving_avg_7d, round(d.moving_avg_30d, 4) AS moving_avg_30d,
 round(d.volatility_7d, 4) AS volatility_7d, round(d.avg_volume_7d, 4) AS avg_volume_7d,
 s.fear_greed_value, s.classification AS market_sentiment, s.sentiment_score,
 CASE WHEN d.price_usd > d.moving_avg_30d THEN 'ABOVE_MA30' ELSE 'BELOW_MA30' END AS ma30_signal
 FROM daily d LEFT JOIN stg_sent s ON d.price_date = s.index_date""",
)
def fact_binary(spark, sf):
    fact = gold.fact_market_daily(common.prices(spark, sf), common.sentiment(spark, sf), "binary")
    return common.rounded(fact, 4, "moving_avg_7d", "moving_avg_30d", "volatility_7d", "avg_volume_7d")


@query(
    "s28_fact_without_sentiment",
    """SELECT coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, price_change_pct_1d, moving_avg_7d,
 moving_avg_30d, volatility_7d, avg_volume_7d, CAST(NULL AS INTEGER) AS fear_greed_value,
 CAST(NULL AS VARCHAR) AS market_sentiment, ma30_signal, 'HOLD' AS combined_signal FROM fact""",
)
def fact_without_sentiment(spark, sf):
    return gold.fact_market_daily(common.prices(spark, sf), None)


@query("m1_w1_silver_daily_prices", "SELECT * FROM s_prices")
def silver_prices(spark, sf):
    return common.prices(spark, sf)


@query(
    "m1_w1_ties_and_small_prices",
    """SELECT coin_id, price_date, max(p) AS price_usd, arg_max_null(m, p) AS market_cap_usd, arg_max_null(v, p) AS volume_24h_usd FROM
 (SELECT coin_id, CAST(make_timestamp(timestamp_ms * 1000) AS DATE) AS price_date, CASE WHEN market_cap_usd < 3000 THEN -price_usd ELSE price_usd / 1e9 END AS p,
 CASE WHEN market_cap_usd > 0 THEN market_cap_usd END AS m, CASE WHEN volume_24h_usd > 0 THEN volume_24h_usd END AS v FROM hist)
 GROUP BY 1, 2 HAVING max(p) > 0""",
)
def ties_and_small_prices(spark, sf):
    """All rows of one load: the price decides, however small, and no negative one hides a day."""
    rows = stand_ins.bronze_prices(spark, sf)
    price = F.when(F.col("market_cap_usd") < 3000, -F.col("price_usd")).otherwise(F.col("price_usd") / 1e9)
    return silver.daily_prices(rows.withColumns({"price_usd": price, "_ingested_at": F.lit("2024-01-02T00:00:00+00:00")}))


@query("m2_w1_silver_sentiment", "SELECT * FROM s_sent")
def silver_sentiment(spark, sf):
    return common.sentiment(spark, sf)


@query(
    "m3_w2_w7_stg_prices",
    """SELECT coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, prev_day_price, recency_rank,
 price_change_pct_1d FROM stg""",
)
def stg_prices(spark, sf):
    return gold.stg_prices(common.prices(spark, sf))


@query("m4_p10_stg_sentiment", "SELECT * FROM stg_sent")
def stg_sentiment(spark, sf):
    return gold.stg_sentiment(common.sentiment(spark, sf))


@query(
    "m5_p7_p8_stg_market_metrics",
    """SELECT coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, price_change_pct_1d,
 CASE WHEN market_cap_usd > 0 THEN round(volume_24h_usd / market_cap_usd * 100, 4) END AS volume_to_mcap_pct
 FROM stg WHERE market_cap_usd IS NOT NULL""",
)
def stg_market_metrics(spark, sf):
    return gold.stg_market_metrics(gold.stg_prices(common.prices(spark, sf)))


_DAILY = """coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, price_change_pct_1d,
 round(moving_avg_7d, 4) AS moving_avg_7d, round(moving_avg_30d, 4) AS moving_avg_30d,
 round(volatility_7d, 4) AS volatility_7d, round(avg_volume_7d, 4) AS avg_volume_7d"""
_ROLLED = ("moving_avg_7d", "moving_avg_30d", "volatility_7d", "avg_volume_7d")


@query("m6_w3_w4_w5_w6_w10_int_price_daily", f"SELECT {_DAILY} FROM daily")
def int_price_daily(spark, sf):
    return common.rounded(gold.int_price_daily(gold.stg_prices(common.prices(spark, sf))), 4, *_ROLLED)


@query(
    "m7_j1_p20_int_market_enriched",
    f"""SELECT {_DAILY}, s.fear_greed_value, s.classification AS market_sentiment, s.sentiment_score
 FROM daily d LEFT JOIN stg_sent s ON d.price_date = s.index_date""",
)
def int_market_enriched(spark, sf):
    daily = gold.int_price_daily(gold.stg_prices(common.prices(spark, sf)))
    return common.rounded(gold.int_market_enriched(daily, common.sentiment(spark, sf)), 4, *_ROLLED)


@query("m8_a1_p9_dim_coins", "SELECT * FROM coins")
def dim_coins(spark, sf):
    return gold.dim_coins(common.prices(spark, sf))


@query(
    "m8_a1_dim_coins_unrounded",
    """SELECT coin_id, min(price_date) AS first_tracked_date, max(price_date) AS last_tracked_date,
 count(DISTINCT price_date) AS total_days_tracked, min(price_usd) AS all_time_low, max(price_usd) AS all_time_high,
 round(avg(price_usd), 5) AS avg_price, round(avg(volume_24h_usd), 5) AS avg_daily_volume,
 round((max(price_usd) - min(price_usd)) / nullif(min(price_usd), 0) * 100, 2) AS price_range_pct
 FROM s_prices GROUP BY 1""",
)
def dim_coins_unrounded(spark, sf):
    dim = gold.dim_coins(common.prices(spark, sf), rounded=False)
    return common.rounded(dim, 5, "avg_price", "avg_daily_volume").drop(
        "max_daily_volume", "max_market_cap", "latest_market_cap"
    )


@query("m9_a7_p13_p14_p15_dim_dates", "SELECT * FROM dates")
def dim_dates(spark, sf):
    return gold.dim_dates(common.prices(spark, sf))


@query(
    "m14_k1_range_ranking",
    "SELECT coin_id, total_days_tracked, all_time_low, all_time_high, price_range_pct FROM coins ORDER BY price_range_pct DESC",
)
def range_ranking(spark, sf):
    return gold.range_ranking(gold.dim_coins(common.prices(spark, sf)))


@query(
    "m14_k2_calendar_sample",
    "SELECT date_day, day_name, month_name, quarter, is_weekend FROM dates ORDER BY date_day DESC LIMIT 5",
)
def calendar_sample(spark, sf):
    return gold.calendar_sample(gold.dim_dates(common.prices(spark, sf)))


@query(
    "m14_k2_last_seven_days",
    """SELECT price_date, round(price_usd, 2) AS price, price_change_pct_1d AS change_pct,
 round(moving_avg_7d, 2) AS ma7, round(moving_avg_30d, 2) AS ma30, ma30_signal, market_sentiment, combined_signal
 FROM fact WHERE coin_id = '1-URGENT' ORDER BY price_date DESC LIMIT 7""",
)
def last_days(spark, sf):
    return gold.last_days(common.fact(spark, sf), "1-URGENT")


@query(
    "m14_w11_k4_latest_signals",
    """SELECT coin_id, price_date, round(price_usd, 4) AS price, price_change_pct_1d, ma30_signal, market_sentiment,
 combined_signal FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY price_date DESC) AS rn FROM fact)
 WHERE rn = 1 ORDER BY combined_signal, coin_id""",
)
def latest_signals(spark, sf):
    return gold.latest_signals(common.fact(spark, sf))


@query(
    "a16_p26_volatility_ranking",
    """SELECT coin_id, round(avg(volatility_7d), 4) AS avg_volatility, round(avg(price_change_pct_1d), 4) AS avg_daily_change
 FROM fact WHERE price_date >= DATE '2001-08-02' - 30 GROUP BY 1 ORDER BY avg_volatility DESC""",
)
def volatility_ranking(spark, sf):
    return gold.volatility_ranking(common.fact(spark, sf), common.as_of_day())


@query(
    "j3_weekend_effect",
    """SELECT f.coin_id, d.is_weekend, round(avg(f.price_change_pct_1d), 4) AS avg_change_pct, count(*) AS num_days
 FROM fact f JOIN dates d ON f.price_date = d.date_day GROUP BY 1, 2""",
)
def weekend_effect(spark, sf):
    prices = common.prices(spark, sf)
    return gold.weekend_effect(common.fact(spark, sf), gold.dim_dates(prices))


@query(
    "j3_weekend_fear_price",
    """SELECT f.coin_id, round(avg(f.price_usd), 4) AS avg_price FROM fact f JOIN dates d ON f.price_date = d.date_day
 WHERE d.is_weekend AND f.market_sentiment = 'Extreme Fear' GROUP BY 1""",
)
def weekend_fear_price(spark, sf):
    prices = common.prices(spark, sf)
    return common.rounded(gold.weekend_fear_price(common.fact(spark, sf), gold.dim_dates(prices)), 4, "avg_price")


@query(
    "j2_orphan_sentiment_days",
    "SELECT s.index_date, s.fear_greed_value FROM s_sent s WHERE s.index_date NOT IN (SELECT date_day FROM dates)",
)
def orphan_days(spark, sf):
    dates = gold.dim_dates(common.prices(spark, sf))
    rows = common.sentiment(spark, sf).select("index_date", "fear_greed_value")
    return orphans(rows, dates, "index_date", "date_day")


@query(
    "j4_merge_latest_year",
    """SELECT coin_id, price_date, CASE WHEN price_date >= DATE '2001-01-01' THEN price_usd * 2 ELSE price_usd END AS price_usd
 FROM s_prices UNION ALL
 SELECT coin_id, price_date + 10000, price_usd * 2 FROM s_prices WHERE price_date >= DATE '2001-01-01'""",
)
def merge_latest(spark, sf):
    target = common.prices(spark, sf).select("coin_id", "price_date", "price_usd")
    changed = target.filter(F.col("price_date") >= F.lit("2001-01-01").cast("date"))
    changed = changed.withColumn("price_usd", F.col("price_usd") * 2)
    new = changed.withColumn("price_date", F.date_add("price_date", 10000))
    return merged(target, changed.unionByName(new), ["coin_id", "price_date"])


@query(
    "j9_newer_than_target",
    """SELECT coin_id, price_date, price_usd FROM s_prices
 WHERE price_date > (SELECT max(price_date) FROM s_prices WHERE coin_id = '1-URGENT' AND price_date < DATE '2000-01-01')""",
)
def newer_rows(spark, sf):
    prices = common.prices(spark, sf).select("coin_id", "price_date", "price_usd")
    loaded = prices.filter((F.col("coin_id") == "1-URGENT") & (F.col("price_date") < F.lit("2000-01-01").cast("date")))
    return newer_than(prices, loaded, "price_date")


@query(
    "j8_w12_d1_compare_assets",
    """SELECT price_date, max(CASE WHEN coin_id = '1-URGENT' THEN round(normalized, 6) END) AS a_normalized,
 max(CASE WHEN coin_id = '1-URGENT' THEN volume_24h_usd END) AS a_volume,
 max(CASE WHEN coin_id = '5-LOW' THEN round(normalized, 6) END) AS b_normalized,
 max(CASE WHEN coin_id = '5-LOW' THEN volume_24h_usd END) AS b_volume
 FROM (SELECT *, price_usd / first_value(price_usd) OVER (PARTITION BY coin_id ORDER BY price_date) * 100 AS normalized
       FROM s_prices) WHERE coin_id IN ('1-URGENT', '5-LOW') GROUP BY 1""",
)
def compare_assets(spark, sf):
    both = dashboard.compare_assets(common.prices(spark, sf), "1-URGENT", "5-LOW")
    return common.rounded(both, 6, "a_normalized", "b_normalized")


@query(
    "w12_rebase_all",
    """SELECT coin_id, price_date, round(price_usd / first_value(price_usd) OVER (PARTITION BY coin_id ORDER BY price_date) * 100, 6)
 AS normalized FROM s_prices""",
)
def rebase_all(spark, sf):
    return common.rounded(dashboard.rebase(common.prices(spark, sf)), 6, "normalized").select(
        "coin_id", "price_date", "normalized"
    )


@query(
    "w3_w5_rolling_chunked",
    """SELECT coin_id, window_start, round(avg("close") OVER (PARTITION BY coin_id ORDER BY window_start ROWS BETWEEN 29 PRECEDING
 AND CURRENT ROW), 6) AS avg_30, round(stddev("close") OVER (PARTITION BY coin_id ORDER BY window_start ROWS BETWEEN 6 PRECEDING
 AND CURRENT ROW), 6) AS std_7, lag("close") OVER (PARTITION BY coin_id ORDER BY window_start) AS prev_close FROM bars30""",
)
def rolling_chunked(spark, sf):
    measures = {"avg_30": ("avg", "close", 30), "std_7": ("stddev", "close", 7), "prev_close": ("lag", "close", 1)}
    base = common.silver_bars(spark, sf).select("coin_id", "window_start", "close")
    rolled = rolling(base, ["coin_id"], "window_start", measures, chunk_rows=512)
    return common.rounded(rolled, 6, "avg_30", "std_7").drop("close")


@query(
    "p1_p3_p4_epoch_columns",
    """SELECT coin_id, trade_time_ms, CAST(t AS DATE) AS trade_date, t AS trade_time, date_trunc('hour', t) AS trade_hour,
 CAST(date_trunc('day', t) AS TIMESTAMP) AS trade_day, time_bucket(INTERVAL '4 hours', t) AS four_hours FROM trades""",
)
def epoch_columns(spark, sf):
    ms = F.col("trade_time_ms")
    ts = times.ms_to_timestamp(ms)
    return stand_ins.bronze_trades(spark, sf).select(
        "coin_id",
        "trade_time_ms",
        times.ms_to_date(ms).alias("trade_date"),
        ts.alias("trade_time"),
        F.date_trunc("hour", ts).alias("trade_hour"),
        F.date_trunc("day", ts).alias("trade_day"),
        F.window(ts, "4 hours")["start"].alias("four_hours"),
    )


@query(
    "p2_p24_epoch_seconds",
    """SELECT "timestamp", index_date, CASE WHEN "timestamp" > 0 THEN strftime(index_date, '%Y-%m-%d') ELSE 'N/A' END AS date_str,
 CASE WHEN 0 - "timestamp" > 0 THEN '' ELSE 'N/A' END AS negative_str FROM sent_raw""",
)
def epoch_seconds(spark, sf):
    s = F.col("timestamp")
    return stand_ins.bronze_sentiment(spark, sf).select(
        "timestamp",
        times.seconds_to_date(s).alias("index_date"),
        times.seconds_label(s).alias("date_str"),
        times.seconds_label(-s).alias("negative_str"),
    )


@query(
    "p5_p6_positive_or_null",
    """SELECT coin_id, timestamp_ms, price_usd, CASE WHEN market_cap_usd > 0 THEN market_cap_usd END AS market_cap_usd
 FROM hist WHERE price_usd > 0""",
)
def positive(spark, sf):
    from marketloom.functions.numbers import positive_or_null

    rows = stand_ins.bronze_prices(spark, sf).filter(F.col("price_usd") > 0)
    return rows.select(
        "coin_id", "timestamp_ms", "price_usd", positive_or_null(F.col("market_cap_usd")).alias("market_cap_usd")
    )


@query(
    "p11_p12_d3_d4_d5_signal_labels",
    """SELECT coin_id, price_date,
 CASE WHEN price_usd > moving_avg_30d THEN 'ABOVE_MA30' WHEN price_usd < moving_avg_30d THEN 'BELOW_MA30' ELSE 'AT_MA30' END AS tri,
 CASE WHEN price_usd > moving_avg_30d THEN 'ABOVE_MA30' ELSE 'BELOW_MA30' END AS two, combined_signal,
 CASE WHEN coalesce(price_change_pct_1d, 0) < -5 THEN 'OVERSOLD' WHEN coalesce(price_change_pct_1d, 0) < -2 THEN 'WEAK'
      WHEN coalesce(price_change_pct_1d, 0) > 5 THEN 'OVERBOUGHT' WHEN coalesce(price_change_pct_1d, 0) > 2 THEN 'STRONG'
      ELSE 'NEUTRAL' END AS technical,
 CASE WHEN coalesce(fear_greed_value, 50) < 30 AND coalesce(price_change_pct_1d, 0) < -2 THEN 'BUY'
      WHEN coalesce(fear_greed_value, 50) > 70 AND coalesce(price_change_pct_1d, 0) > 2 THEN 'SELL' ELSE 'HOLD' END AS matrix,
 CASE WHEN fear_greed_value < 25 THEN 'Extreme Fear' WHEN fear_greed_value < 45 THEN 'Fear' WHEN fear_greed_value < 55
      THEN 'Neutral' WHEN fear_greed_value < 75 THEN 'Greed' WHEN fear_greed_value >= 75 THEN 'Extreme Greed' END AS band
 FROM fact""",
)
def signal_labels(spark, sf):
    price, mean = F.col("price_usd"), F.col("moving_avg_30d")
    value, change = F.col("fear_greed_value"), F.col("price_change_pct_1d")
    return common.fact(spark, sf).select(
        "coin_id",
        "price_date",
        labels.trend_signal(price, mean).alias("tri"),
        labels.trend_signal(price, mean, "binary").alias("two"),
        labels.contrarian_signal(price, mean, value).alias("combined_signal"),
        labels.change_class(change).alias("technical"),
        labels.matrix_signal(value, change).alias("matrix"),
        labels.sentiment_band(value).alias("band"),
    )


@query(
    "p18_p19_date_differences",
    """SELECT coin_id, count(*) AS days, CAST(max(price_date) - min(price_date) + 1 AS INTEGER) AS span_days,
 CAST(date_diff('hour', CAST(max(price_date) AS TIMESTAMP), TIMESTAMP '2001-08-02 00:00:00') AS BIGINT) AS hours_behind
 FROM s_prices GROUP BY 1""",
)
def date_differences(spark, sf):
    newest = F.max("price_date").cast("timestamp")
    return (
        common.prices(spark, sf)
        .groupBy("coin_id")
        .agg(
            F.count(F.lit(1)).alias("days"),
            (F.datediff(F.max("price_date"), F.min("price_date")) + 1).alias("span_days"),
            times.hours_since(newest, common.as_of_day().cast("timestamp")).alias("hours_behind"),
        )
    )


@query(
    "p27_outside_accepted_values",
    """SELECT classification, index_date FROM s_sent WHERE classification NOT IN ('Extreme Fear', 'Fear', 'Neutral', 'Greed', 'Extreme Greed')""",
)
def outside_accepted(spark, sf):
    rows = common.sentiment(spark, sf).select("classification", "index_date")
    return rows.filter(~F.col("classification").isin(labels.CLASSES))


@query(
    "a9_class_frequencies",
    "SELECT classification, count(*) AS n FROM sent_raw GROUP BY 1 ORDER BY n DESC, classification",
)
def class_frequencies(spark, sf):
    from marketloom.operators.profile import frequencies

    return frequencies(stand_ins.bronze_sentiment(spark, sf), "classification")


@query(
    "a17_records_per_asset",
    "SELECT coin_id, count(*) AS records, count(DISTINCT price_date) AS dates FROM hist GROUP BY 1",
)
def records_per_asset(spark, sf):
    rows = stand_ins.bronze_prices(spark, sf).withColumn("d", times.ms_to_date(F.col("timestamp_ms")))
    return rows.groupBy("coin_id").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("d").alias("dates"))


@query(
    "a5_global_aggregates",
    "SELECT count(*) AS n, min(price_date) AS first_day, max(price_date) AS last_day, count(DISTINCT coin_id) AS assets FROM s_prices",
)
def global_aggregates(spark, sf):
    return common.prices(spark, sf).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("price_date").alias("first_day"),
        F.max("price_date").alias("last_day"),
        F.count_distinct("coin_id").alias("assets"),
    )


@query(
    "a6_duplicate_groups",
    "SELECT coin_id, price_date, count(*) AS n FROM hist GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_groups(spark, sf):
    from marketloom.plans.quality import duplicate_groups as groups

    rows = stand_ins.bronze_prices(spark, sf).withColumn("price_date", times.ms_to_date(F.col("timestamp_ms")))
    return groups(rows, ["coin_id", "price_date"])


@query(
    "k3_latest_single_row",
    """SELECT coin_id, price_date, price_usd FROM s_prices ORDER BY price_date DESC, coin_id DESC LIMIT 1""",
)
def latest_single(spark, sf):
    rows = common.prices(spark, sf).select("coin_id", "price_date", "price_usd")
    return latest.newest(rows, [F.desc("price_date"), F.desc("coin_id")], 1)


@query(
    "k6_k7_distinct_keep_last",
    """SELECT coin_id, price_usd, price_date FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, price_usd ORDER BY price_date DESC)
 AS rn FROM s_prices) WHERE rn = 1""",
)
def keep_last(spark, sf):
    rows = common.prices(spark, sf).select("coin_id", "price_usd", "price_date")
    return latest.dedup_latest(rows, ["coin_id", "price_usd"], [F.col("price_date")])


@query(
    "k8_tail_per_series",
    """SELECT coin_id, window_start, "close" FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY window_start DESC) AS rn
 FROM bars30) WHERE rn <= 120""",
)
def tail_per_series(spark, sf):
    rows = common.bars(spark, sf).select("coin_id", "window_start", "close")
    return latest.newest_per_key(rows, ["coin_id"], [F.desc("window_start")], 120)


@query(
    "k5_newest_then_ascending",
    """SELECT * FROM (SELECT price_date, price_usd FROM s_prices WHERE coin_id = '2-HIGH' ORDER BY price_date DESC LIMIT 100)
 ORDER BY price_date""",
)
def newest_then_ascending(spark, sf):
    rows = common.prices(spark, sf).filter(F.col("coin_id") == "2-HIGH").select("price_date", "price_usd")
    return latest.newest_then_ascending(rows, "price_date", 100)


@query(
    "u1_union_sources",
    """SELECT coin_id, CAST(price_date AS TIMESTAMP) AS ts, price_usd, 'daily' AS source FROM s_prices
 UNION ALL SELECT coin_id, window_start, "close", 'realtime' FROM bars30""",
)
def union_sources(spark, sf):
    from marketloom.plans.training import union_sources as union

    daily = common.prices(spark, sf).select("coin_id", F.col("price_date").cast("timestamp").alias("ts"), "price_usd")
    live = common.bars(spark, sf).select("coin_id", F.col("window_start").alias("ts"), F.col("close").alias("price_usd"))
    return union({"daily": daily, "realtime": live})


@query(
    "u2_samples_per_source",
    """SELECT source, coin_id, count(*) AS samples FROM (SELECT 'daily' AS source, coin_id FROM s_prices
 UNION ALL SELECT 'realtime', coin_id FROM bars30) GROUP BY 1, 2""",
)
def samples_per_source(spark, sf):
    rows = union_sources(spark, sf)
    return rows.groupBy("source", "coin_id").agg(F.count(F.lit(1)).alias("samples"))
