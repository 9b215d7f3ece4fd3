"""Physical plans: what must be pushed down, shared or absent."""

import re

import pytest
from pyspark.sql import functions as F

from marketloom.operators.bars import vwap_bars
from marketloom.plans import features as feat
from marketloom.plans import gold, silver
from marketloom.queries import common, queries
from marketloom.session import staged
from marketloom.sources import stand_ins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_windows_share_one_sort(spark, sf):
    prices = staged(common.prices(spark, sf))
    text = plan(gold.fact_market_daily(prices, None))
    assert text.count("Exchange hashpartitioning(coin_id") == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_dedup_aggregates_before_the_exchange(spark, sf):
    text = plan(silver.daily_sentiment(stand_ins.bronze_sentiment(spark, sf)))
    assert "partial_max_by" in text and "Window" not in text


def test_bars_are_hash_aggregated(spark, sf):
    text = plan(vwap_bars(stand_ins.ticks(spark, sf)))
    assert "SortAggregate" not in text
    assert text.count("HashAggregate") == 2 and "partial_min_by" in text
    assert "user_id" not in text.split("FileScan")[1].split("Batched")[0]


def test_features_use_chunked_windows_and_one_pass(spark, sf):
    bars = staged(common.bars(spark, sf))
    text = plan(feat.build_features(bars))
    assert text.count("Exchange hashpartitioning(coin_id#") >= 1
    assert len(re.findall(r"Exchange hashpartitioning\(coin_id#\d+, _chunk#", text)) == 1
    per_series = re.findall(r"Window \[.*?\], \[(coin_id#\d+)\], \[", text)
    assert len(per_series) <= 1, "only the per-bucket counts may be ordered per series"


@pytest.mark.parametrize(
    "name",
    ["j7_match_predictions", "m10_fact_market_daily", "j2_orphan_sentiment_days", "s18_s22_upsert_prices", "l8_l10_trend_forecast"],
)
def test_no_cross_products(spark, sf, name):
    text = plan(queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_small_staged_side_is_broadcast(spark, sf):
    from marketloom.plans.dashboard import rebase

    text = plan(rebase(staged(common.prices(spark, sf))))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_no_broadcast_above_the_threshold(spark, sf):
    from marketloom.plans.dashboard import rebase

    prices = staged(common.prices(spark, sf))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        rebased = rebase(prices)
        assert "SortMergeJoin" in plan(rebased)
        assert rebased.agg(F.count("*")).first()[0] == prices.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_staged_tables_are_released(spark):
    from marketloom.session import path_exists, release_staged, staged, unstage

    one, two = staged(spark.range(3)), staged(spark.range(4))
    paths = [f.inputFiles()[0].rsplit("/", 1)[0] for f in (one, two)]
    unstage(one)
    assert [path_exists(spark, p) for p in paths] == [False, True]
    release_staged(spark)
    assert not path_exists(spark, paths[1])
