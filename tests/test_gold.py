"""Silver and gold rules: reloads, incremental loads, signals."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marketloom.functions import labels
from marketloom.operators import merge
from marketloom.plans import dashboard, gold, serving, silver
from marketloom.queries import common
from marketloom.session import scratch_path
from marketloom.streaming import loads

DAY = dt.date(2024, 1, 1)
SENTIMENT = "value int, classification string, timestamp long, time_until_update string, _ingested_at string, _source string"


def bronze(spark, data):
    schema = (
        "coin_id string, timestamp_ms long, price_usd double, market_cap_usd double, volume_24h_usd double,"
        " _ingested_at string, _source string"
    )
    return spark.createDataFrame(data, schema)


def test_latest_ingest_wins_across_offsets(spark):
    ms = 1704067200000
    df = bronze(
        spark,
        [
            ("a", ms, 1.0, 0.0, 5.0, "2024-01-02T01:00:00+02:00", "x"),
            ("a", ms + 1, 2.0, 7.0, -1.0, "2024-01-02T00:30:00+00:00", "x"),
            ("b", ms, -3.0, 1.0, 1.0, "2024-01-02T00:00:00+00:00", "x"),
        ],
    )
    rows = silver.daily_prices(df).collect()
    assert [tuple(r) for r in rows] == [("a", DAY, 2.0, 7.0, None)]


@pytest.mark.parametrize("low, high", [(-1.0, 0.00005), (0.00001, 0.00002), (None, 1e300), (2.0, 2.0)])
def test_ties_do_not_depend_on_the_order_of_rows(spark, low, high):
    rows = [("a", 1704067200000, p, m, None, "2024-01-02T00:00:00+00:00", "x") for p, m in ((low, 5.0), (high, 7.0), (high, None), (low, None))]
    got = {tuple(silver.daily_prices(bronze(spark, order).coalesce(1)).collect()) for order in (rows, rows[::-1], rows[2:] + rows[:2])}
    assert len(got) == 1 and got.pop()[0].price_usd == high


def test_keep_latest_sorts_nothing(spark):
    plans = [silver.daily_prices(bronze(spark, [])), silver.daily_sentiment(spark.createDataFrame([], SENTIMENT))]
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text and "Sort [" not in text


def test_two_readings_of_one_day_make_one_row(spark):
    df = spark.createDataFrame(
        [
            (10, "Extreme Fear", 1704067200, None, "2024-01-01T00:00:00+00:00", "x"),
            (90, "Extreme Greed", 1704070800, None, "2024-01-01T02:00:00+00:00", "x"),
        ],
        SENTIMENT,
    )
    assert [tuple(r) for r in silver.daily_sentiment(df).collect()] == [(90, "Extreme Greed", DAY)]


def test_zero_price_before_gives_no_change(spark):
    df = spark.createDataFrame(
        [("a", DAY, 0.0, 1.0, 1.0), ("a", DAY + dt.timedelta(1), 5.0, 1.0, 1.0)],
        "coin_id string, price_date date, price_usd double, market_cap_usd double, volume_24h_usd double",
    )
    assert [r.price_change_pct_1d for r in gold.fact_market_daily(df).orderBy("price_date").collect()] == [None, None]


@pytest.mark.parametrize("mode", ["tri", "binary"])
def test_incremental_fact_equals_full_refresh(spark, sf, mode):
    prices, sentiment = common.prices(spark, sf).cache(), common.sentiment(spark, sf).cache()
    path = scratch_path(spark, "fact")
    for end in ("1999-06-01", "2000-01-01", "2000-01-01", "2003-01-01"):
        gold.load_fact(spark, path, prices.filter(F.col("price_date") < F.lit(end).cast("date")), sentiment, mode)
    loaded = spark.read.parquet(path).drop("price_month", "source_hash")
    full = gold.fact_market_daily(prices, sentiment, mode).select(loaded.columns)
    near = ["moving_avg_7d", "moving_avg_30d", "volatility_7d", "avg_volume_7d"]
    loaded, full = common.rounded(loaded, 6, *near), common.rounded(full, 6, *near)
    assert loaded.exceptAll(full).count() == 0 and full.exceptAll(loaded).count() == 0


def _daily(spark, rows):
    return spark.createDataFrame(
        [(c, DAY + dt.timedelta(d), p, 1.0, 1.0) for c, d, p in rows],
        "coin_id string, price_date date, price_usd double, market_cap_usd double, volume_24h_usd double",
    )


def _index(spark, rows):
    schema = "fear_greed_value int, classification string, index_date date"
    return spark.createDataFrame([(v, "Fear", DAY + dt.timedelta(d)) for v, d in rows], schema)


def test_lagging_restated_and_late_days_reach_the_fact(spark):
    """One asset behind the other, an old price corrected, old sentiment arriving late: equal to a full build."""
    path = scratch_path(spark, "fact")
    first = [("a", d, 10.0 + d) for d in range(50)] + [("b", d, 5.0 + d % 7) for d in range(40)]
    later = [(c, d, 99.0 if (c, d) == ("a", 3) else p) for c, d, p in first] + [("b", d, 5.0 + d % 7) for d in range(40, 52)]
    loads = [(first, [(30, d) for d in range(40)]), (later, [(30 + (d == 8), d) for d in range(52)])]
    for prices, index in loads:
        gold.load_fact(spark, path, _daily(spark, prices), _index(spark, index))
    loaded = spark.read.parquet(path).drop("price_month", "source_hash")
    full = gold.fact_market_daily(_daily(spark, later), _index(spark, loads[1][1])).select(loaded.columns)
    assert loaded.count() == 102
    assert loaded.exceptAll(full).count() == 0 and full.exceptAll(loaded).count() == 0


TRADES = "coin_id string, trade_time_ms long, price_usd double, quantity double, ingested_at string"


def _arrive(spark, bronze, data):
    spark.createDataFrame(data, TRADES).coalesce(1).write.mode("append").parquet(bronze)


def test_late_trades_reach_closed_bars(spark, rows):
    first = [("a", 0, 10.0, 1.0, "x"), ("a", 90_000_000, 20.0, 1.0, "x"), ("a", None, 7.0, 1.0, "x")]
    late = [("a", 1000, 5.0, 1.0, "x")]
    bronze, path, wide = (scratch_path(spark, n) for n in ("bronze", "hourly", "ohlc"))
    loads.load_hourly(spark, path, bronze)  # no table yet
    for data in (first, late, []):
        _arrive(spark, bronze, data)
        loads.load_hourly(spark, path, bronze)
        loads.load_ohlc(spark, wide, bronze)
    got = rows(spark.read.parquet(path).filter("price_hour IS NOT NULL"), "min_price", "close_price", "trade_count")
    assert got == [(20.0, 20.0, 1), (5.0, 5.0, 2)]
    bars = rows(spark.read.parquet(wide).filter("low = 5.0"), "timeframe", "open", "close")
    assert bars == [("1d", 10.0, 5.0), ("1h", 10.0, 5.0), ("4h", 10.0, 5.0)]


@pytest.mark.parametrize("step", ["upsert", "_replace_partitions"])
def test_a_load_that_fails_is_repeated_without_loss(spark, rows, monkeypatch, step):
    bronze, path = scratch_path(spark, "bronze"), scratch_path(spark, "hourly")
    _arrive(spark, bronze, [("a", 0, 10.0, 1.0, "x"), ("b", 0, 1.0, 1.0, "x")])
    loads.load_hourly(spark, path, bronze)
    _arrive(spark, bronze, [("a", 1000, 11.0, 1.0, "x")])

    def fail(*args):
        if step == "_replace_partitions":  # inside the overwrite: the old rows are gone already
            merge.drop_path(spark, f"{path}/price_day=1970-01-01")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(loads if step == "upsert" else merge, step, fail)
        with pytest.raises(StreamingQueryException):
            loads.load_hourly(spark, path, bronze)
    loads.load_hourly(spark, path, bronze)
    assert rows(spark.read.parquet(path), "coin_id", "open_price", "close_price", "trade_count") == [("a", 10.0, 11.0, 2), ("b", 1.0, 1.0, 1)]


def test_only_months_that_differ_are_read_again(spark, rows):
    path = scratch_path(spark, "fact")
    days = [("a", d, 10.0 + d) for d in range(70)]
    gold.load_fact(spark, path, _daily(spark, days), _index(spark, []))
    files = lambda: {f.rsplit("/", 1)[1] for f in spark.read.parquet(path).filter("price_month < '1970-03'").inputFiles()}
    before = files()
    gold.load_fact(spark, path, _daily(spark, days), _index(spark, []))
    gold.load_fact(spark, path, _daily(spark, [*days[:-1], ("a", 69, 1.0)]), _index(spark, []))
    assert len(before & files()) > 0
    assert spark.read.parquet(path).agg(F.min("price_usd")).first()[0] == 1.0


def test_labels_at_their_limits(spark):
    df = spark.createDataFrame([(24,), (25,), (44,), (45,), (54,), (55,), (74,), (75,), (None,)], "v int")
    got = [r[0] for r in df.select(labels.sentiment_band(F.col("v"))).collect()]
    assert got == [
        "Extreme Fear", "Fear", "Fear", "Neutral", "Neutral", "Greed", "Greed", "Extreme Greed", None,
    ]
    one = spark.createDataFrame([(60.0, 1.9, 61.0), (59.9, 1.0, 1.0), (70.0, 5.0, 1.0)], "d double, m double, x double")
    assert [r[0] for r in one.select(labels.reliability(F.col("d"), F.col("m"))).collect()] == ["HIGH", "MEDIUM", "LOW"]
    score = spark.createDataFrame([("Greed",), ("unknown",), (None,)], "c string")
    assert [r[0] for r in score.select(labels.sentiment_score(F.col("c"))).collect()] == [4, None, None]


def test_change_classes_and_matrix(spark):
    df = spark.createDataFrame([(-5.1, 29), (-5.0, 30), (-2.0, 10), (2.1, 71), (5.1, 70), (None, None)], "c double, v int")
    out = df.select(labels.change_class(F.col("c")), labels.matrix_signal(F.col("v"), F.col("c"))).collect()
    assert [tuple(r) for r in out] == [
        ("OVERSOLD", "BUY"), ("WEAK", "HOLD"), ("NEUTRAL", "HOLD"), ("STRONG", "SELL"), ("OVERBOUGHT", "HOLD"), ("NEUTRAL", "HOLD"),
    ]


def test_sentiment_defaults_when_empty(spark):
    empty = spark.createDataFrame([], "value int, classification string, timestamp long, _ingested_at string")
    assert tuple(serving.latest_sentiment(empty).first()) == (50, "Neutral", 0)


def test_primary_prediction_falls_back(spark):
    df = spark.createDataFrame([("ensemble", "a", dt.datetime(2024, 1, 1), 1.0)], "model string, coin_id string, ts timestamp, predicted_price double")
    assert serving.latest_prediction(df, "a").first().is_primary
    both = df.unionByName(df.withColumn("model", F.lit("legacy")))
    assert {r.model: r.is_primary for r in serving.latest_prediction(both, "a").collect()} == {"ensemble": False, "legacy": True}


def test_forecast_delta_guards_zero(spark):
    df = spark.createDataFrame([(11.0, 10.0), (1.0, 0.0)], "predicted_price double, current_price double")
    assert [r.delta_pct for r in dashboard.forecast_delta(df).collect()] == pytest.approx([10.0, 0.0])
