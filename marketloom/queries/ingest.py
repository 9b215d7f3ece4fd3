"""Parsing, validation, table maintenance and scans."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.labels import sentiment_band
from marketloom.operators import merge, profile
from marketloom.plans import gold, silver
from marketloom.plans import quality as dq
from marketloom.queries import common
from marketloom.queries.oracle import BAND
from marketloom.queries.registry import query
from marketloom.schemas import BRONZE_PRICES
from marketloom.session import scratch_path, staged
from marketloom.sources import ingest, payloads, scan, stand_ins, trades
from marketloom.streaming import loads

# The usable messages of the stand-in topic, restated over the events.
_USABLE = "user_id % 10 <> 3 AND user_id % 11 <> 5 AND (user_id % 13 <> 12 OR user_id % 7 = 6)"
_COIN = """CASE user_id % 9 WHEN 0 THEN 'bitcoin' WHEN 1 THEN 'ethereum' WHEN 2 THEN 'solana' WHEN 3 THEN 'cardano'
 WHEN 4 THEN 'polkadot' WHEN 5 THEN 'chainlink' WHEN 6 THEN 'avalanche-2' WHEN 7 THEN 'matic-network' ELSE coin_id END"""
_PAIR = """CASE user_id % 9 WHEN 0 THEN 'BTCUSDT' WHEN 1 THEN 'ETHUSDT' WHEN 2 THEN 'SOLUSDT' WHEN 3 THEN 'ADAUSDT'
 WHEN 4 THEN 'DOTUSDT' WHEN 5 THEN 'LINKUSDT' WHEN 6 THEN 'AVAXUSDT' WHEN 7 THEN 'MATICUSDT' ELSE symbol END"""


@query(
    "s1_s2_j5_normalise_trades",
    f"""SELECT {_COIN} AS coin_id, {_PAIR} AS symbol, price_usd, quantity, trade_time_ms,
 CASE WHEN user_id % 3 > 0 THEN event_time_ms + 1 ELSE 0 END AS event_time_ms, 'binance_websocket' AS source,
 CASE WHEN user_id % 4 > 0 THEN is_buyer_maker ELSE false END AS is_buyer_maker FROM trades WHERE {_USABLE}""",
)
def normalise_trades(spark, sf):
    raw = stand_ins.trade_messages(spark, sf)
    return trades.trades_from_messages(raw, F.lit("2024-01-31T00:00:00+00:00")).drop("ingested_at")


@query(
    "s2_quarantined_messages",
    """SELECT problem, count(*) AS messages FROM (SELECT CASE WHEN user_id % 13 = 12 AND user_id % 7 <> 6 THEN 'malformed'
 WHEN user_id % 10 = 3 THEN NULL WHEN user_id % 11 = 5 THEN 'ill_typed' END AS problem FROM trades)
 WHERE problem IS NOT NULL GROUP BY 1""",
)
def quarantined(spark, sf):
    return (
        trades.quarantined(stand_ins.trade_messages(spark, sf))
        .groupBy("problem")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@query(
    "s3_s5_topic_round_trip",
    """SELECT coin_id, symbol, price_usd, quantity, trade_time_ms, event_time_ms,
 strftime(ingested, '%Y-%m-%dT%H:%M:%S+00:00') AS ingested_at, 'events' AS source, is_buyer_maker FROM trades""",
)
def topic_round_trip(spark, sf):
    return trades.from_topic(trades.to_topic(stand_ins.bronze_trades(spark, sf)))


@query(
    "s6_s14_stamp_and_conform",
    """SELECT coin_id, timestamp_ms, price_usd, market_cap_usd, volume_24h_usd, 'orders' AS _source,
 TIMESTAMP '2024-01-31 00:00:00' AS _spark_ingested_at FROM hist""",
)
def stamp_and_conform(spark, sf):
    rows = ingest.conform(stand_ins.bronze_prices(spark, sf), BRONZE_PRICES)
    return ingest.stamp(rows, common.as_of_time()).drop("_ingested_at")


_POINTS = """(SELECT o_orderpriority AS coin_id, 8 + o_orderkey % 5 AS n, epoch_ms(o_orderdate) + i * 3600000 AS timestamp_ms,
 o_totalprice + i AS price_usd, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_custkey * 1000 + i AS DOUBLE) END AS market_cap_usd,
 CASE WHEN o_orderkey % 2 = 1 AND i = 7 + o_orderkey % 5 THEN NULL ELSE CAST(o_orderkey % 100 + i AS DOUBLE) END AS volume_24h_usd
 FROM (SELECT *, unnest(range(8 + o_orderkey % 5)) AS i FROM orders))"""


@query(
    "s8_j6_price_payload_rows",
    f"SELECT coin_id, timestamp_ms, price_usd, market_cap_usd, volume_24h_usd FROM {_POINTS}",
)
def price_payload_rows(spark, sf):
    return payloads.price_history_rows(stand_ins.price_payloads(spark, sf))


@query(
    "s9_hourly_training_rows",
    f"""SELECT coin_id, epoch_ms(timestamp_ms) AS "timestamp", price_usd, coalesce(volume_24h_usd, 0) AS volume_usd
 FROM {_POINTS} WHERE n >= 10""",
)
def hourly_training_rows(spark, sf):
    return payloads.hourly_training_rows(stand_ins.price_payloads(spark, sf))


@query(
    "s10_sentiment_payload_rows",
    f"""SELECT value, {BAND.format(v='value')} AS classification, "timestamp", '43200' AS time_until_update FROM
 (SELECT value, "timestamp" FROM sent_raw UNION ALL SELECT 100 - value, "timestamp" + 43200 FROM sent_raw)""",
)
def sentiment_payload_rows(spark, sf):
    return payloads.sentiment_rows(stand_ins.sentiment_payloads(spark, sf))


def _dirty_prices(spark, sf):
    """Prices with missing ids and non-positive prices where the balance is low."""
    rows = stand_ins.bronze_prices(spark, sf)
    low = F.col("market_cap_usd") < 0
    return rows.withColumns(
        {
            "coin_id": F.when(F.col("market_cap_usd") > 9000, F.lit("")).otherwise(F.col("coin_id")),
            "price_usd": F.when(low, -F.col("price_usd")).otherwise(F.col("price_usd")),
        }
    )


@query(
    "s11_valid_prices",
    """SELECT coin_id, timestamp_ms, price_usd, market_cap_usd, volume_24h_usd, 'checked' AS _source FROM hist
 WHERE NOT market_cap_usd > 9000 AND NOT market_cap_usd < 0 AND price_usd > 0 AND timestamp_ms > 0""",
)
def valid_prices(spark, sf):
    stamped = ingest.ingest(_dirty_prices(spark, sf), ingest.valid_price(), "checked", F.lit("2024-01-31T00:00:00+00:00"))
    return stamped.drop("_ingested_at")


@query(
    "s13_ingest_counts",
    """SELECT count(*) AS raw, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS dropped FROM
 (SELECT NOT market_cap_usd > 9000 AND NOT market_cap_usd < 0 AND price_usd > 0 AND timestamp_ms > 0 AS ok FROM hist)""",
)
def ingest_counts(spark, sf):
    return ingest.ingest_counts(_dirty_prices(spark, sf), ingest.valid_price())


@query(
    "s12_valid_sentiment",
    """SELECT value * 2 - 50 AS value, "timestamp" FROM sent_raw WHERE value * 2 - 50 BETWEEN 0 AND 100 AND "timestamp" > 0""",
)
def valid_sentiment(spark, sf):
    rows = stand_ins.bronze_sentiment(spark, sf).withColumn("value", F.col("value") * 2 - 50)
    return rows.filter(ingest.valid_sentiment()).select("value", "timestamp")


@query(
    "s15_s16_table_scan",
    """SELECT coin_id, price_usd, quantity, trade_time_ms FROM trades""",
)
def table_scan(spark, sf):
    """Bronze trades written in the lake layout (by ingest date, sorted by time) and scanned back."""
    path = scratch_path(spark, "trades")
    rows = stand_ins.bronze_trades(spark, sf).withColumn("ingest_date", F.to_date(F.to_timestamp("ingested_at")))
    merge.write_table(rows, path, ["ingest_date"], ["coin_id", "trade_time_ms"])
    return scan.read_table(spark, path).select("coin_id", "price_usd", "quantity", "trade_time_ms")


@query(
    "s17_p26_pushed_scan",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'
 AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""",
)
def pushed_scan(spark, sf):
    orders = stand_ins.table(spark, sf, "orders")
    year = F.col("o_orderdate").between(
        F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1997-12-31").cast("timestamp_ntz")
    )
    wanted = ["o_orderkey", "o_orderdate", "o_totalprice", "not_there"]
    return scan.scan(orders, wanted, (F.col("o_orderpriority") == "1-URGENT") & year)


def _by_year(prices):
    return prices.withColumn("price_year", F.year("price_date"))


@query(
    "s18_s22_upsert_prices",
    """SELECT coin_id, price_date, CASE WHEN price_date >= DATE '2000-07-01' THEN price_usd + 1 ELSE price_usd END AS price_usd
 FROM s_prices""",
)
def upsert_prices(spark, sf):
    """Load the years before 2001, then merge changed and new rows from mid-2000 on."""
    path = scratch_path(spark, "silver")
    prices = _by_year(common.prices(spark, sf).select("coin_id", "price_date", "price_usd"))
    keys, parts = ["coin_id", "price_date"], ["price_year"]
    merge.upsert(spark, path, prices.filter("price_year < 2001"), keys, parts, ["coin_id", "price_date"])
    late = prices.filter(F.col("price_date") >= F.lit("2000-07-01").cast("date"))
    merge.upsert(spark, path, late.withColumn("price_usd", F.col("price_usd") + 1), keys, parts)
    return spark.read.parquet(path).select("coin_id", "price_date", "price_usd")


@query("s19_incremental_fact", "SELECT * FROM fact")
def incremental_fact(spark, sf):
    """Three incremental loads must equal the full refresh."""
    path = scratch_path(spark, "fact")
    prices, sentiment = staged(common.prices(spark, sf), "prices"), staged(common.sentiment(spark, sf), "sentiment")
    for end in ("2001-07-01", "2001-07-15", "2002-01-01"):
        gold.load_fact(spark, path, prices.filter(F.col("price_date") < F.lit(end).cast("date")), sentiment)
    return spark.read.parquet(path).drop("price_month", "source_hash")


def _loaded_fact(spark, *loads):
    """The fact after one incremental load of each (prices, sentiment)."""
    path = scratch_path(spark, "fact")
    for prices, sentiment in loads:
        gold.load_fact(spark, path, staged(prices, "prices"), staged(sentiment, "sentiment"))
    return spark.read.parquet(path).drop("price_month", "source_hash")


@query("s19_lagging_asset", "SELECT * FROM fact")
def lagging_asset(spark, sf):
    """One asset is months ahead of the others in the first load; the rest arrives later."""
    prices, sentiment = common.prices(spark, sf), common.sentiment(spark, sf)
    ahead = (F.col("coin_id") == "1-URGENT") | (F.col("price_date") < F.lit("2001-03-01").cast("date"))
    return _loaded_fact(spark, (prices.filter(ahead), sentiment), (prices, sentiment))


@query("s19_restated_day", "SELECT * FROM fact")
def restated_day(spark, sf):
    """Old days are loaded with wrong prices, missing days and wrong volumes, then corrected."""
    prices, sentiment = common.prices(spark, sf), common.sentiment(spark, sf)
    third = F.dayofmonth("price_date") == 3
    wrong = prices.filter(F.dayofmonth("price_date") != 17).withColumns(
        {
            "price_usd": F.when(third, F.col("price_usd") * 2).otherwise(F.col("price_usd")),
            "volume_24h_usd": F.when(F.dayofmonth("price_date") == 9, F.lit(None)).otherwise(F.col("volume_24h_usd")),
        }
    )
    return _loaded_fact(spark, (wrong, sentiment), (prices, sentiment))


@query("s19_changed_sentiment_day", "SELECT * FROM fact")
def changed_sentiment_day(spark, sf):
    """Sentiment of loaded days arrives late or changes."""
    prices, sentiment = common.prices(spark, sf), common.sentiment(spark, sf)
    fifth = F.dayofmonth("index_date") == 5
    early = sentiment.filter(F.col("index_date") < F.lit("2001-05-01").cast("date")).withColumn(
        "fear_greed_value", F.when(fifth, 100 - F.col("fear_greed_value")).otherwise(F.col("fear_greed_value"))
    )
    return _loaded_fact(spark, (prices, early), (prices, sentiment))


_HOURLY = """SELECT coin_id, price_hour, round(avg_price, 9) AS avg_price, min_price, max_price, open_price, close_price,
 total_quantity, trade_count FROM hourly"""


def _hourly(spark, *arrivals):
    """The hourly table after one load of each batch of arriving rows, appended to one bronze table."""
    path, bronze = scratch_path(spark, "hourly"), scratch_path(spark, "bronze")
    for rows in arrivals:
        ingest.append(rows, bronze, ["ingest_date"])
        loads.load_hourly(spark, path, bronze)
    return common.rounded(spark.read.parquet(path).drop("price_day"), 9, "avg_price")


def _stamped(rows, stamp):
    return rows.withColumns({"_spark_ingested_at": stamp, "ingest_date": F.to_date(stamp)})


@query("s19_equal_load_second", _HOURLY)
def equal_load_second(spark, sf):
    """Three loads whose rows all carry the same write stamp, from a table partitioned by ingest day."""
    rows = _stamped(stand_ins.bronze_trades(spark, sf), F.lit("2024-02-02 00:00:00").cast("timestamp"))
    third = F.pmod(F.xxhash64("trade_time_ms"), F.lit(3))
    return _hourly(spark, *[rows.filter(third == part) for part in range(3)])


@query("s19_x10_incremental_hourly", _HOURLY)
def incremental_hourly(spark, sf):
    """Two loads; the second brings late trades for hours that were already built."""
    rows, late = stand_ins.bronze_trades(spark, sf), F.col("quantity") > 90
    day = lambda d: F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp")
    return _hourly(spark, _stamped(rows.filter(~late), day(1)), _stamped(rows.filter(late), day(2)))


@query("s19_late_commit", _HOURLY)
def late_commit(spark, sf):
    """A long job commits rows hours after it stamped them, when later stamps have been loaded."""
    rows = stand_ins.bronze_trades(spark, sf)
    slow = F.pmod(F.xxhash64("trade_time_ms", "price_usd"), F.lit(7)) == 0
    early, noon = (F.lit(f"2024-02-02 {h}:00:00").cast("timestamp") for h in ("03", "12"))
    return _hourly(spark, _stamped(rows.filter(~slow), noon), _stamped(rows.filter(slow), early))


@query("s19_clock_skew", _HOURLY)
def clock_skew(spark, sf):
    """Writers whose clocks run behind stamp rows with a day before their trades."""
    rows = stand_ins.bronze_trades(spark, sf)
    behind = F.pmod(F.xxhash64("trade_time_ms", "quantity"), F.lit(3)) == 0
    traded = F.timestamp_millis("trade_time_ms")
    return _hourly(spark, _stamped(rows.filter(behind), traded - F.expr("interval 2 days")), _stamped(rows.filter(~behind), traded))


@query("m12_s16_incremental_ohlc", "SELECT * FROM ohlc")
def incremental_ohlc(spark, sf):
    """Four loads in mixed order, each in micro-batches of one file, and a load that finds nothing new."""
    path, bronze = scratch_path(spark, "ohlc"), scratch_path(spark, "bronze")
    rows = stand_ins.bronze_trades(spark, sf).withColumn("ingest_date", F.lit("2024-02-02").cast("date"))
    for part in (2, 0, 3, 1):
        ingest.append(rows.filter(F.pmod(F.xxhash64("trade_time_ms"), F.lit(4)) == part), bronze, ["ingest_date"])
        loads.load_ohlc(spark, path, bronze, max_files=4)
    loads.load_ohlc(spark, path, bronze)
    return spark.read.parquet(path).drop("bucket_day")


@query("s19_value_moves_column", "SELECT * FROM fact")
def value_moves_column(spark, sf):
    """A measure that was loaded into the wrong one of two nullable columns is put right."""
    prices, sentiment = common.prices(spark, sf), common.sentiment(spark, sf)
    only = F.col("volume_24h_usd").isNull() | F.col("market_cap_usd").isNull()
    swapped = prices.withColumns(
        {
            "market_cap_usd": F.when(only, F.col("volume_24h_usd")).otherwise(F.col("market_cap_usd")),
            "volume_24h_usd": F.when(only, F.col("market_cap_usd")).otherwise(F.col("volume_24h_usd")),
        }
    )
    return _loaded_fact(spark, (swapped, sentiment), (prices, sentiment))


@query("s20_s21_full_refresh_fact", "SELECT * FROM fact")
def full_refresh_fact(spark, sf):
    path = scratch_path(spark, "fact")
    gold.refresh_fact(path, common.prices(spark, sf), common.sentiment(spark, sf))
    return spark.read.parquet(path).drop("price_month", "source_hash")


@query(
    "m1_m2_s18_load_silver",
    """SELECT p.coin_id, p.price_date, p.price_usd, s.fear_greed_value FROM s_prices p JOIN s_sent s ON p.price_date = s.index_date""",
)
def load_silver(spark, sf):
    """Bronze to silver through the upserting loaders, run twice: a repeat changes nothing."""
    prices_path, sentiment_path = scratch_path(spark, "prices"), scratch_path(spark, "sentiment")
    for _ in range(2):
        silver.load_daily_prices(spark, prices_path, stand_ins.bronze_prices(spark, sf), common.as_of_time())
        silver.load_daily_sentiment(spark, sentiment_path, stand_ins.bronze_sentiment(spark, sf), common.as_of_time())
    prices = spark.read.parquet(prices_path)
    sentiment = spark.read.parquet(sentiment_path).withColumnRenamed("index_date", "price_date")
    return prices.join(sentiment, "price_date").select("coin_id", "price_date", "price_usd", "fear_greed_value")


@query(
    "s23_s24_newest_check_reports",
    """SELECT classification AS table_name, max(index_date) AS checked_at, arg_max(fear_greed_value, index_date) AS metric_value
 FROM s_sent GROUP BY 1""",
)
def newest_reports(spark, sf):
    """Results appended day by day (here: sentiment days per class), the newest kept per table."""
    from marketloom.plans.serving import latest_reports

    path = scratch_path(spark, "results")
    rows = common.sentiment(spark, sf).select(
        F.col("classification").alias("table_name"),
        F.col("index_date").alias("checked_at"),
        F.col("fear_greed_value").alias("metric_value"),
    )
    cut = F.lit("1998-01-01").cast("date")
    ingest.append(rows.filter(F.col("checked_at") < cut), path)
    ingest.append(rows.filter(F.col("checked_at") >= cut), path)
    return latest_reports(spark.read.parquet(path))


@query(
    "s25_compacted_table",
    "SELECT coin_id, CAST(year(price_date) AS INTEGER) AS price_year, count(*) AS n, min(price_usd) AS low, max(price_usd) AS high FROM s_prices GROUP BY 1, 2",
)
def compacted(spark, sf):
    """Six appends leave small files; compaction keeps every row."""
    path = scratch_path(spark, "compact-me")
    prices = _by_year(common.prices(spark, sf).select("coin_id", "price_date", "price_usd"))
    for part in range(6):
        slice_ = prices.filter(F.pmod(F.dayofyear("price_date"), F.lit(6)) == part)
        ingest.append(slice_.coalesce(1), path, ["price_year"])
    merge.compact(spark, path, ["price_year"], ["coin_id", "price_date"])
    return (
        spark.read.parquet(path)
        .groupBy("coin_id", "price_year")
        .agg(F.count(F.lit(1)).alias("n"), F.min("price_usd").alias("low"), F.max("price_usd").alias("high"))
    )


@query(
    "s26_row_counts",
    """SELECT 'daily_prices' AS table_name, count(*) AS row_count FROM s_prices UNION ALL
 SELECT 'fear_greed', count(*) FROM s_sent UNION ALL SELECT 'realtime_prices', count(*) FROM trades""",
)
def row_counts(spark, sf):
    return profile.row_counts(
        {
            "daily_prices": common.prices(spark, sf),
            "fear_greed": common.sentiment(spark, sf),
            "realtime_prices": stand_ins.bronze_trades(spark, sf),
            "absent": scan.read_optional(spark, f"{sf}/absent.parquet"),
        }
    )


@query(
    "s26_samples",
    """SELECT 'daily_prices' AS table_name, coin_id || ' ' || strftime(price_date, '%Y-%m-%d') AS row_key, price_usd AS value FROM
 (SELECT * FROM s_prices ORDER BY coin_id, price_date LIMIT 5)
 UNION ALL SELECT 'fear_greed', strftime(index_date, '%Y-%m-%d'), fear_greed_value FROM (SELECT * FROM s_sent ORDER BY index_date LIMIT 5)""",
)
def samples(spark, sf):
    """Five rows of each table, the first ones by key."""
    prices = profile.sample(common.prices(spark, sf), ["coin_id", "price_date"])
    sentiment = profile.sample(common.sentiment(spark, sf), ["index_date"])
    day = F.date_format("price_date", "yyyy-MM-dd")
    return prices.select(
        F.lit("daily_prices").alias("table_name"), F.concat_ws(" ", "coin_id", day).alias("row_key"), F.col("price_usd").alias("value")
    ).unionByName(
        sentiment.select(
            F.lit("fear_greed").alias("table_name"), F.date_format("index_date", "yyyy-MM-dd").alias("row_key"),
            F.col("fear_greed_value").cast("double").alias("value"),
        )
    )


@query(
    "s27_csv_seed_join",
    """SELECT n.n_name, count(*) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1""",
)
def csv_seed(spark, sf):
    """A dimension loaded from CSV with an explicit schema and joined to a table."""
    path = scratch_path(spark, "seed")
    stand_ins.table(spark, sf, "nation").select("n_nationkey", "n_name").write.option("header", "true").csv(path)
    schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())])
    seed = scan.read_seed(spark, path, schema)
    customers = stand_ins.table(spark, sf, "customer")
    joined = customers.join(seed, customers.c_nationkey == seed.n_nationkey)
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "u3_q3_missing_columns",
    """SELECT 'schema_check' AS check_name, 'failed' AS status, CAST(NULL AS DOUBLE) AS metric_value, 'missing: [''_loaded_at'']' AS message
 UNION ALL SELECT 'min_row_count', CASE WHEN n >= 50 THEN 'passed' ELSE 'failed' END, CAST(n AS DOUBLE), 'rows: ' || n
 FROM (SELECT count(*) AS n FROM hist)""",
)
def missing_columns(spark, sf):
    """A table without a required column: its rows still count."""
    df = stand_ins.bronze_prices(spark, sf)
    schema = dq.schema_check(spark, df, "bronze", "historical_prices", ["coin_id", "price_usd", "_loaded_at"])
    rows = dq.run_checks(df, "bronze", "historical_prices", [dq.min_row_count(50)])
    return schema.unionByName(rows).select("check_name", "status", "metric_value", "message")


@query(
    "p10_d5_sentiment_scores",
    """SELECT value, CASE WHEN value < 25 THEN 1 WHEN value < 45 THEN 2 WHEN value < 55 THEN 3 WHEN value < 75 THEN 4 ELSE 5 END
 AS score, count(*) AS n FROM sent_raw GROUP BY 1, 2""",
)
def sentiment_scores(spark, sf):
    from marketloom.functions.labels import sentiment_score

    rows = stand_ins.bronze_sentiment(spark, sf)
    score = sentiment_score(sentiment_band(F.col("value")))
    return rows.groupBy("value", score.alias("score")).agg(F.count(F.lit(1)).alias("n"))
