"""The daily run end to end."""

import datetime as dt

from pyspark.sql import functions as F

from marketloom.plans import gold, lake, quality, serving
from marketloom.queries import common
from marketloom.session import scratch_path, staged
from marketloom.sources import stand_ins


def test_two_days_of_runs(spark, sf):
    root = scratch_path(spark, "lake")
    prices, sentiment = stand_ins.bronze_prices(spark, sf), stand_ins.bronze_sentiment(spark, sf)
    trades = staged(stand_ins.bronze_trades(spark, sf))
    first, second = (F.lit(dt.datetime(2001, 8, d)).cast("timestamp") for d in (2, 3))
    cut = F.col("timestamp_ms") < F.unix_millis(F.lit("2000-06-01").cast("timestamp"))
    lake.load(spark, root, prices.filter(cut), sentiment, None, first)
    quality.assert_no_failures(lake.check(spark, root, first))
    lake.load(spark, root, prices, sentiment, trades.inputFiles()[0].rsplit("/", 1)[0], second)
    quality.assert_no_failures(lake.check(spark, root, second))

    table = lambda name: spark.read.parquet(f"{root}/{name}")
    near = ["moving_avg_7d", "moving_avg_30d", "volatility_7d", "avg_volume_7d"]
    fact = common.rounded(table(lake.FACT).drop("price_month", "source_hash"), 5, *near)
    full = common.rounded(gold.fact_market_daily(common.prices(spark, sf), common.sentiment(spark, sf)), 5, *near)
    assert fact.select(full.columns).exceptAll(full).count() == 0 and fact.count() == full.count()
    assert table(lake.HOURLY).agg(F.sum("trade_count")).first()[0] == trades.count()
    reports = serving.latest_reports(table(lake.REPORTS))
    assert {r.checked_at.day for r in reports.collect()} == {3}
    assert reports.count() == 5 and table(lake.REPORTS).count() == 10
