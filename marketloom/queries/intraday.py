"""Bars over trades and features over bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions.numbers import clip, finite
from marketloom.operators import bars as ops
from marketloom.plans import features as feat
from marketloom.queries import common
from marketloom.queries.registry import query
from marketloom.sources import stand_ins

_BAR_SQL = """coin_id, window_start, window_end, round(vwap, 9) AS vwap, total_volume, round(avg_price, 9) AS avg_price,
 round(stddev_price, 9) AS stddev_price, open, high, low, "close", round(z_score, 9) + 0.0 AS z_score, is_anomaly"""
_BAR_ROUND = ("vwap", "avg_price", "stddev_price", "z_score")


@query("m13_a2_a3_a4_p16_p17_vwap_bars_30s", f"SELECT {_BAR_SQL} FROM bars30")
def bars_30s(spark, sf):
    return common.rounded(common.bars(spark, sf), 9, *_BAR_ROUND)


@query("m13_vwap_bars_1h", f"SELECT {_BAR_SQL} FROM bars1h")
def bars_1h(spark, sf):
    return common.rounded(common.bars(spark, sf, "1 hour"), 9, *_BAR_ROUND)


@query(
    "x2_sliding_vwap_bars",
    """SELECT coin_id, s AS window_start, round(sum(price_usd * quantity) / nullif(sum(quantity), 0), 9) AS vwap,
 sum(quantity) AS total_volume, max(price_usd) AS high, min(price_usd) AS low FROM
 (SELECT *, unnest([time_bucket(INTERVAL '30 minutes', t), time_bucket(INTERVAL '30 minutes', t) - INTERVAL '30 minutes']) AS s
  FROM trades) GROUP BY 1, 2""",
)
def sliding_bars(spark, sf):
    rows = ops.vwap_bars(stand_ins.ticks(spark, sf), "1 hour", "30 minutes")
    return common.rounded(rows.select("coin_id", "window_start", "vwap", "total_volume", "high", "low"), 9, "vwap")


@query(
    "m11_w8_w9_fact_price_hourly",
    """SELECT coin_id, price_hour, round(avg_price, 9) AS avg_price, min_price, max_price, open_price, close_price,
 total_quantity, trade_count FROM hourly""",
)
def hourly(spark, sf):
    return common.rounded(ops.hourly_prices(stand_ins.ticks(spark, sf)), 9, "avg_price")


@query("m12_a8_market_ohlc", "SELECT * FROM ohlc")
def market_ohlc(spark, sf):
    return ops.market_ohlc(stand_ins.ticks(spark, sf))


_WINDOWED = """coin_id, ts, round(return_1, 6) + 0.0 AS return_1, round(return_3, 6) + 0.0 AS return_3, round(return_5, 6) + 0.0 AS return_5,
 round(return_10, 6) + 0.0 AS return_10, round(volatility_5, 6) + 0.0 AS volatility_5, round(volatility_10, 6) + 0.0 AS volatility_10,
 round(volatility_20, 6) + 0.0 AS volatility_20, round(bb_position, 6) + 0.0 AS bb_position, round(volume_ratio_5, 6) + 0.0 AS volume_ratio_5,
 round(volume_ratio_10, 6) + 0.0 AS volume_ratio_10, round(momentum_5, 6) + 0.0 AS momentum_5, round(momentum_10, 6) + 0.0 AS momentum_10"""
_WINDOW_NAMES = [
    "return_1", "return_3", "return_5", "return_10", "volatility_5", "volatility_10", "volatility_20", "bb_position",
    "volume_ratio_5", "volume_ratio_10", "momentum_5", "momentum_10",
]


@query("f1_f2_f6_f7_f8_p21_window_features", f"SELECT {_WINDOWED} FROM windowed")
def window_features(spark, sf):
    placed = feat.positions(common.silver_bars(spark, sf), ["coin_id"], "window_start", "close", "total_volume")
    rows = feat.window_features(placed, ["coin_id"]).select("coin_id", "ts", *_WINDOW_NAMES)
    return common.rounded(rows, 6, *_WINDOW_NAMES)


_SMOOTH_NAMES = ["rsi_7", "rsi_14", "macd", "macd_signal", "macd_hist"]


@query(
    "f3_f4_f5_f9_rsi_macd",
    "SELECT coin_id, ts, round(rsi_7, 6) + 0.0 AS rsi_7, round(rsi_14, 6) + 0.0 AS rsi_14, round(macd, 6) + 0.0 AS macd,"
    " round(macd_signal, 6) + 0.0 AS macd_signal, round(macd_hist, 6) + 0.0 AS macd_hist FROM feats",
)
def rsi_macd(spark, sf):
    rows = common.features(spark, sf).select("coin_id", "ts", *_SMOOTH_NAMES)
    return common.rounded(rows, 6, *_SMOOTH_NAMES)


@query(
    "f4_ema_12_26",
    """SELECT s.coin_id, s.ts, round(m.e12, 6) AS ema_fast, round(m.e26, 6) AS ema_slow
 FROM ser s JOIN smooth m ON s.coin_id = m.coin_id AND s.pos = m.pos""",
)
def ema(spark, sf):
    keys = ["coin_id"]
    placed = feat.positions(common.silver_bars(spark, sf), keys, "window_start", "close", "total_volume")
    rows = feat.window_features(placed, keys)
    return common.rounded(rows.select("coin_id", "ts", "ema_fast", "ema_slow"), 6, "ema_fast", "ema_slow")


@query(
    "f10_f16_sma_and_scaling",
    """SELECT coin_id, ts, round(sma_5, 6) AS sma_5, round(sma_10, 6) AS sma_10,
 round((price - min(price) OVER p) / coalesce(nullif(max(price) OVER p - min(price) OVER p, 0), 1), 6) AS price_norm,
 round((volume - min(volume) OVER p) / coalesce(nullif(max(volume) OVER p - min(volume) OVER p, 0), 1), 6) AS volume_norm,
 round(greatest(-1, least(1, (sma_5 - sma_10) / (sma_10 + 1e-10) * 10)), 6) AS sma_ratio
 FROM windowed WINDOW p AS (PARTITION BY coin_id)""",
)
def sma_and_scaling(spark, sf):
    rows = common.features(spark, sf).select("coin_id", "ts", "price", "volume", "sma_5", "sma_10")
    scaled = feat.min_max_scaled(rows, ["coin_id"], ["price", "volume"])
    scaled = scaled.withColumn("sma_ratio", feat.sma_cross(F.col("sma_5"), F.col("sma_10")))
    return common.rounded(scaled, 6, "sma_5", "sma_10", "price_norm", "volume_norm", "sma_ratio").drop("price", "volume")


@query(
    "a14_series_extremes",
    "SELECT coin_id, min(price) AS low, max(price) AS high, min(volume) AS low_volume, max(volume) AS high_volume FROM ser GROUP BY 1",
)
def series_extremes(spark, sf):
    rows = common.features(spark, sf).select("coin_id", "price", "volume")
    return rows.groupBy("coin_id").agg(
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.min("volume").alias("low_volume"),
        F.max("volume").alias("high_volume"),
    )


@query(
    "f11_f12_p22_sentiment_and_hour",
    """SELECT coin_id, ts, round(fear_greed_norm, 6) AS fear_greed_norm, round(hour_sin, 6) + 0.0 AS hour_sin,
 round(hour_cos, 6) + 0.0 AS hour_cos FROM feats""",
)
def sentiment_and_hour(spark, sf):
    names = ["fear_greed_norm", "hour_sin", "hour_cos"]
    return common.rounded(common.features(spark, sf).select("coin_id", "ts", *names), 6, *names)


_ALL = ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in feat.FEATURES)


@query("f13_p23_feature_matrix", f"SELECT coin_id, ts, {_ALL} FROM feats")
def feature_matrix(spark, sf):
    rows = common.features(spark, sf).select("coin_id", "ts", *feat.FEATURES)
    return common.rounded(rows, 6, *feat.FEATURES)


@query(
    "f13_short_series",
    "SELECT coin_id, count(*) AS bars FROM bars30 GROUP BY 1 HAVING count(*) < 34",
)
def short_series(spark, sf):
    return feat.short_series(common.bars(spark, sf), ["coin_id"])


@query(
    "f14_l15_training_samples",
    """SELECT coin_id, ts, round((future_price - price) / (price + 1e-10), 6) + 0.0 AS forward_return,
 CAST((future_price - price) / (price + 1e-10) > 0 AS DOUBLE) AS label
 FROM feat0 WHERE pos >= 30 AND pos < len - 3""",
)
def training_samples(spark, sf):
    rows = feat.training_samples(common.features(spark, sf)).select("coin_id", "ts", "forward_return", "label")
    return common.rounded(rows, 6, "forward_return")




# Every value of a sequence, weighted by its place: oldest row first, features in order.
_PLACED = " + ".join(
    f"{(10 - k) * len(feat.FEATURES) + j} * lag({name}, {k}) OVER o" for k in range(1, 11) for j, name in enumerate(feat.FEATURES, 1)
)


@query(
    "f15_sequence_samples",
    f"""SELECT coin_id, ts, 200 AS n_values, round(placed, 4) + 0.0 AS placed FROM (SELECT coin_id, ts, pos, {_PLACED} AS placed
 FROM feats WINDOW o AS (PARTITION BY coin_id ORDER BY pos)) WHERE pos >= 10""",
)
def sequence_samples(spark, sf):
    rows = feat.with_sequences(common.features(spark, sf))
    placed = F.aggregate(F.transform("sequence", lambda x, i: x * (i + 1)), F.lit(0.0), lambda total, x: total + x)
    out = rows.select("coin_id", "ts", F.size("sequence").alias("n_values"), placed.alias("placed"))
    return common.rounded(out, 4, "placed")


@query(
    "f17_f18_votes",
    """SELECT coin_id, ts, round(greatest(-1, least(1, 0.6 * greatest(-1, least(1, (50 - coalesce(rsi_raw_14, 50)) / 50))
 + 0.4 * greatest(-1, least(1, (sma_5 - sma_10) / (sma_10 + 1e-10) * 10)))), 6) AS technical,
 round(fear_greed_norm, 6) AS sentiment FROM feats""",
)
def agent_votes(spark, sf):
    rows = common.features(spark, sf).select(
        "coin_id",
        "ts",
        feat.technical_vote(F.col("rsi_raw_14"), F.col("sma_5"), F.col("sma_10")).alias("technical"),
        F.col("fear_greed_norm").alias("sentiment"),
    )
    return common.rounded(rows, 6, "technical", "sentiment")


@query(
    "p21_p23_clip_and_finite",
    """SELECT event_id, greatest(-1, least(1, (value - 20) / 10)) AS clipped,
 CASE WHEN k = 0 THEN CASE WHEN value > 20 THEN 0.5 WHEN value < 20 THEN -0.5 ELSE 0 END ELSE round((value - 20) / k, 9) END AS cleaned
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""",
)
def clip_and_finite(spark, sf):
    k = F.get_json_object("props", "$.k").cast("double")
    x = F.col("value") - 20
    raw = F.when(k != 0, F.try_divide(x, k)).otherwise(
        F.when(x > 0, F.lit(float("inf"))).when(x < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    )
    rows = stand_ins.table(spark, sf, "events")
    return rows.select("event_id", clip(x / 10, -1, 1).alias("clipped"), F.round(finite(raw), 9).alias("cleaned"))
