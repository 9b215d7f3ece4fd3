"""Silver to gold: staging models, rolling indicators and the star schema.

Series here have one row per asset and day, so a series is bounded by the calendar (some
36,500 rows per century) and plain per-asset windows are safe. Intraday series go through
``operators.series`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.functions.labels import contrarian_signal, sentiment_score, trend_signal
from marketloom.functions.numbers import pct_change, share_pct
from marketloom.functions.times import calendar_columns
from marketloom.operators.latest import newest, newest_per_key, rank_recency
from marketloom.operators.merge import around_changes, changed, recover, upsert, write_table
from marketloom.operators.series import rolling
from marketloom.session import drop_beside, path_exists, staged

FACT_KEY = ["coin_id", "price_date"]
LOOKBACK_ROWS = 29
DIGESTS = "__digests"

ROLLING = {
    "moving_avg_7d": ("avg", "price_usd", 7),
    "moving_avg_30d": ("avg", "price_usd", 30),
    "volatility_7d": ("stddev", "price_usd", 7),
    "avg_volume_7d": ("avg", "volume_24h_usd", 7),
}


def stg_prices(prices: DataFrame) -> DataFrame:
    day = Window.partitionBy("coin_id").orderBy("price_date")
    before = F.col("prev_day_price")
    lagged = prices.filter(F.col("price_usd") > 0).withColumn("prev_day_price", F.lag("price_usd").over(day))
    ranked = rank_recency(lagged, ["coin_id"], "price_date")
    return ranked.withColumn(
        "price_change_pct_1d", F.when(before > 0, pct_change(F.col("price_usd"), before))
    )


def stg_sentiment(sentiment: DataFrame) -> DataFrame:
    return sentiment.withColumn("sentiment_score", sentiment_score(F.col("classification")))


def stg_market_metrics(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("market_cap_usd").isNotNull()).select(
        "coin_id",
        "price_date",
        "price_usd",
        "market_cap_usd",
        "volume_24h_usd",
        "price_change_pct_1d",
        share_pct(F.col("volume_24h_usd"), F.col("market_cap_usd")).alias("volume_to_mcap_pct"),
    )


def int_price_daily(staged: DataFrame) -> DataFrame:
    """Unrounded rolling indicators; the four frames share one exchange and one sort."""
    base = staged.select(
        "coin_id", "price_date", "price_usd", "market_cap_usd", "volume_24h_usd", "price_change_pct_1d"
    )
    return rolling(base, ["coin_id"], "price_date", ROLLING)


def int_market_enriched(daily: DataFrame, sentiment: DataFrame) -> DataFrame:
    scored = stg_sentiment(sentiment).select(
        F.col("index_date").alias("price_date"),
        "fear_greed_value",
        F.col("classification").alias("market_sentiment"),
        "sentiment_score",
    )
    return daily.join(scored, "price_date", "left")


def dim_coins(prices: DataFrame, rounded: bool = True) -> DataFrame:
    """Per-asset statistics; ``latest_market_cap`` is the last known value beside the maximum."""

    def r(col: Column, digits: int) -> Column:
        return F.round(col, digits) if rounded else col

    low, high = F.min("price_usd"), F.max("price_usd")
    return prices.groupBy("coin_id").agg(
        F.min("price_date").alias("first_tracked_date"),
        F.max("price_date").alias("last_tracked_date"),
        F.count_distinct("price_date").alias("total_days_tracked"),
        r(low, 6).alias("all_time_low"),
        r(high, 2).alias("all_time_high"),
        r(F.avg("price_usd"), 6).alias("avg_price"),
        r(F.avg("volume_24h_usd"), 2).alias("avg_daily_volume"),
        F.round(F.max("volume_24h_usd"), 2).alias("max_daily_volume"),
        F.round(F.max("market_cap_usd"), 2).alias("max_market_cap"),
        F.max_by("market_cap_usd", F.when(F.col("market_cap_usd").isNotNull(), F.col("price_date"))).alias(
            "latest_market_cap"
        ),
        F.round(F.try_divide(high - low, low) * 100, 2).alias("price_range_pct"),
    )


def dim_dates(prices: DataFrame) -> DataFrame:
    days = prices.select(F.col("price_date").alias("date_day")).distinct()
    return days.withColumns(calendar_columns(F.col("date_day")))


def fact_market_daily(
    prices: DataFrame,
    sentiment: DataFrame | None = None,
    signal_mode: str = "tri",
    fingerprint: bool = False,
) -> DataFrame:
    """Daily facts: change, rolling indicators, sentiment and signals, one row per asset and day.

    ``fingerprint`` adds ``source_hash``, a hash of the day's inputs. 'tri' rounds the indicators and compares the price with the rounded mean; 'binary' keeps
    them unrounded and adds the sentiment score. Without a sentiment table its columns are NULL.
    """
    day = Window.partitionBy("coin_id").orderBy("price_date")
    change = pct_change(F.col("price_usd"), F.lag("price_usd").over(day))
    metrics = rolling(
        prices.select("coin_id", "price_date", "price_usd", "market_cap_usd", "volume_24h_usd").withColumn(
            "price_change_pct_1d", change
        ),
        ["coin_id"],
        "price_date",
        ROLLING,
    )
    if signal_mode == "tri":
        metrics = metrics.withColumns(
            {
                c: F.round(c, d)
                for c, d in {"moving_avg_7d": 6, "moving_avg_30d": 6, "volatility_7d": 6, "avg_volume_7d": 2}.items()
            }
        )
    if sentiment is None:
        joined = metrics.withColumns(
            {
                "fear_greed_value": F.lit(None).cast("int"),
                "market_sentiment": F.lit(None).cast("string"),
                "sentiment_score": F.lit(None).cast("int"),
            }
        )
    else:
        joined = int_market_enriched(metrics, sentiment)
    price, mean = F.col("price_usd"), F.col("moving_avg_30d")
    signal = trend_signal(price, mean, signal_mode).alias("ma30_signal")
    last = (
        [signal, contrarian_signal(price, mean, F.col("fear_greed_value")).alias("combined_signal")]
        if signal_mode == "tri"
        else ["sentiment_score", signal]
    )
    return joined.select(
        "coin_id",
        "price_date",
        "price_usd",
        "market_cap_usd",
        "volume_24h_usd",
        "price_change_pct_1d",
        "moving_avg_7d",
        "moving_avg_30d",
        "volatility_7d",
        "avg_volume_7d",
        "fear_greed_value",
        "market_sentiment",
        *last,
        *([source_hash().alias("source_hash")] if fingerprint else []),
    )


def source_hash() -> Column:
    """What a fact row takes from its own day; its frames take the same from earlier days.

    The hash passes over nulls, so which inputs are null is hashed too.
    """
    inputs = ["price_usd", "market_cap_usd", "volume_24h_usd", "fear_greed_value", "market_sentiment"]
    return F.xxhash64(*inputs, *[F.col(c).isNull() for c in inputs])


def month_digests(inputs: DataFrame) -> DataFrame:
    """One digest for all days of an asset in a month, from rows with ``price_month`` and ``source_hash``."""
    day = F.xxhash64("price_date", "source_hash")
    return inputs.groupBy("coin_id", "price_month").agg(F.bit_xor(day).alias("digest"), F.sum(F.shiftright(day, 8)).alias("total"), F.count("*").alias("days"))


def _fact_rows(prices: DataFrame, sentiment: DataFrame | None, signal_mode: str) -> DataFrame:
    fact = fact_market_daily(prices, sentiment, signal_mode, fingerprint=True)
    return fact.withColumn("price_month", F.date_format("price_date", "yyyy-MM"))


def _inputs(prices: DataFrame, sentiment: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The price rows, and what the fact takes from each day with its hash and month."""
    rows = prices.select("coin_id", "price_date", "price_usd", "market_cap_usd", "volume_24h_usd")
    if sentiment is None:
        none = {"fear_greed_value": F.lit(None).cast("int"), "market_sentiment": F.lit(None).cast("string")}
        inputs = rows.withColumns(none)
    else:
        inputs = int_market_enriched(rows, sentiment)
    return rows, inputs.select(*FACT_KEY, F.date_format("price_date", "yyyy-MM").alias("price_month"), source_hash().alias("source_hash"))


def load_fact(
    spark: SparkSession, path: str, prices: DataFrame, sentiment: DataFrame | None = None, signal_mode: str = "tri"
) -> None:
    """Incremental fact load whose result equals a full refresh.

    A small table beside the fact holds a digest for each asset and month of what the fact was built
    from. Only months whose digest differs are read from the fact, and their days compared by hash, so
    new, late or restated prices of any asset and new or changed sentiment are all found. Each asset
    is rebuilt from its first changed day to 29 rows after its last one, with the 29 rows before for
    the frames. Digests are written last: after a failure the same months are compared again. Rows
    never leave silver, so none leave the fact; ``refresh_fact`` drops rows.
    """
    if not path_exists(spark, path):
        refresh_fact(path, prices, sentiment, signal_mode)
        return
    recover(spark, path, ["price_month"], FACT_KEY)
    rows, inputs = _inputs(prices, sentiment)
    digests = staged(month_digests(inputs), "digests")
    differing = digests
    if path_exists(spark, path + DIGESTS):
        known = spark.read.parquet(path + DIGESTS).select(*[F.col(c).alias(f"_{c}") for c in digests.columns])
        differing = digests.join(known, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in digests.columns], "left_anti")
    differing = staged(differing.select("coin_id", "price_month"), "differing")
    months = [r[0] for r in differing.select("price_month").distinct().collect()]  # the calendar bounds them
    if not months:
        return
    within = F.col("price_month").isin(months)
    stored = spark.read.parquet(path).filter(within).select(*FACT_KEY, "source_hash")
    compared = inputs.filter(within).join(differing, ["coin_id", "price_month"], "left_semi")
    changes = staged(changed(compared, stored, FACT_KEY, "source_hash"), "changes")
    needed = staged(around_changes(rows, changes, ["coin_id"], "price_date", LOOKBACK_ROWS), "fact-rows")
    fresh = _fact_rows(needed.drop("_rebuild"), sentiment, signal_mode)
    upsert(
        spark, path, fresh.join(needed.filter("_rebuild").select(*FACT_KEY), FACT_KEY, "left_semi"),
        FACT_KEY, ["price_month"], FACT_KEY,
    )
    write_table(digests, path + DIGESTS, [])


def refresh_fact(path: str, prices: DataFrame, sentiment: DataFrame | None = None, signal_mode: str = "tri") -> None:
    drop_beside(prices.sparkSession, path, DIGESTS)
    write_table(_fact_rows(prices, sentiment, signal_mode), path, ["price_month"], FACT_KEY)
    write_table(month_digests(_inputs(prices, sentiment)[1]), path + DIGESTS, [])


def range_ranking(dim: DataFrame) -> DataFrame:
    return dim.select(
        "coin_id", "total_days_tracked", "all_time_low", "all_time_high", "price_range_pct"
    ).orderBy(F.desc("price_range_pct"))


def calendar_sample(dates: DataFrame, n: int = 5) -> DataFrame:
    cols = dates.select("date_day", "day_name", "month_name", "quarter", "is_weekend")
    return newest(cols, [F.desc("date_day")], n)


def last_days(fact: DataFrame, coin_id: str, n: int = 7) -> DataFrame:
    one = fact.filter(F.col("coin_id") == coin_id).select(
        "price_date",
        F.round("price_usd", 2).alias("price"),
        F.col("price_change_pct_1d").alias("change_pct"),
        F.round("moving_avg_7d", 2).alias("ma7"),
        F.round("moving_avg_30d", 2).alias("ma30"),
        "ma30_signal",
        "market_sentiment",
        "combined_signal",
    )
    return newest(one, [F.desc("price_date")], n)


def latest_signals(fact: DataFrame) -> DataFrame:
    latest = newest_per_key(fact, ["coin_id"], [F.col("price_date").desc()])
    return latest.select(
        "coin_id",
        "price_date",
        F.round("price_usd", 4).alias("price"),
        "price_change_pct_1d",
        "ma30_signal",
        "market_sentiment",
        "combined_signal",
    ).orderBy("combined_signal", "coin_id")


def volatility_ranking(fact: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = fact.filter(F.col("price_date") >= F.date_sub(as_of, days))
    return (
        recent.groupBy("coin_id")
        .agg(
            F.round(F.avg("volatility_7d"), 4).alias("avg_volatility"),
            F.round(F.avg("price_change_pct_1d"), 4).alias("avg_daily_change"),
        )
        .orderBy(F.desc("avg_volatility"))
    )


def weekend_effect(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Average change on weekends and working days per asset (inner star join)."""
    return (
        fact.join(dates.select("date_day", "is_weekend"), F.col("price_date") == F.col("date_day"))
        .groupBy("coin_id", "is_weekend")
        .agg(F.round(F.avg("price_change_pct_1d"), 4).alias("avg_change_pct"), F.count(F.lit(1)).alias("num_days"))
    )


def weekend_fear_price(fact: DataFrame, dates: DataFrame, sentiment: str = "Extreme Fear") -> DataFrame:
    """Average weekend price per asset on days of one sentiment class."""
    weekend = dates.filter("is_weekend").select("date_day")
    return (
        fact.filter(F.col("market_sentiment") == sentiment)
        .join(weekend, F.col("price_date") == F.col("date_day"))
        .groupBy("coin_id")
        .agg(F.avg("price_usd").alias("avg_price"))
    )
