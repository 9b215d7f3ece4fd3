"""Voters, forecasts and their evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from marketloom.operators.series import LENGTH, POS
from marketloom.plans import dashboard
from marketloom.plans import features as feat
from marketloom.plans import forecast as fc
from marketloom.plans import serving, training
from marketloom.queries import common
from marketloom.queries.registry import query
from marketloom.session import scratch_path

_LABELLED = """(SELECT *, CAST((future_price - price) / (price + 1e-10) > 0 AS DOUBLE) AS label FROM blended
 WHERE pos >= 30 AND pos < len - 3)"""


def _labelled(spark, sf):
    return fc.blend(common.rule_votes(feat.training_samples(common.features(spark, sf))))


def _report(spark, sf):
    return fc.accuracy_report(_errors(spark, sf))


def _errors(spark, sf):
    table = common.silver_bars(spark, sf)
    bars = table.select("coin_id", F.col("window_start").alias("ts"), "close")
    return fc.prediction_errors(fc.match_predictions(common.predictions(spark, sf, table), bars))


@query(
    "l4_time_split",
    """SELECT coin_id, count(*) FILTER (pos < floor(len * 0.8) - 3) AS train_rows, count(*) FILTER (pos >= floor(len * 0.8)) AS test_rows
 FROM ser WHERE pos >= 30 AND pos < len - 3 GROUP BY 1""",
)
def time_split(spark, sf):
    rows = training.time_split(feat.training_samples(common.features(spark, sf)))
    return rows.groupBy("coin_id").agg(
        F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows")
    )


@query(
    "a15_class_weights",
    f"""SELECT label, n_class, round(sum(n_class) OVER () / (2.0 * n_class), 6) AS weight FROM
 (SELECT label, count(*) AS n_class FROM {_LABELLED} GROUP BY 1)""",
)
def class_weights(spark, sf):
    return common.rounded(training.class_weights(feat.training_samples(common.features(spark, sf))), 6, "weight")


@query(
    "l15_samples_by_asset",
    f"SELECT coin_id, count(*) AS samples, round(avg(label), 6) AS share_up FROM {_LABELLED} GROUP BY 1",
)
def samples_by_asset(spark, sf):
    rows = training.samples_by_asset(feat.training_samples(common.features(spark, sf)))
    return common.rounded(rows, 6, "share_up")


@query(
    "l6_adaptive_weights",
    f"""SELECT voter, round(accuracy, 6) AS accuracy, round(CASE WHEN sum(raw) OVER () > 0 THEN raw / sum(raw) OVER ()
 ELSE CASE voter WHEN 'lstm' THEN 0.34 ELSE 0.33 END END, 6) AS weight FROM
 (SELECT voter, accuracy, CASE WHEN accuracy > 0.5 THEN (accuracy - 0.5) ** 2 ELSE 0 END AS raw FROM
  (SELECT 'gb' AS voter, avg(CASE WHEN (gb_prob > 0.5) = (label = 1) THEN 1.0 ELSE 0 END) AS accuracy FROM {_LABELLED}
   UNION ALL SELECT 'rf', avg(CASE WHEN (rf_prob > 0.5) = (label = 1) THEN 1.0 ELSE 0 END) FROM {_LABELLED}
   UNION ALL SELECT 'lstm', avg(CASE WHEN lstm_prob IS NULL THEN NULL WHEN (lstm_prob > 0.5) = (label = 1) THEN 1.0 ELSE 0 END)
   FROM {_LABELLED}))""",
)
def adaptive_weights(spark, sf):
    return common.rounded(fc.adaptive_weights(training.voter_accuracy(_labelled(spark, sf))), 6, "accuracy", "weight")


@query(
    "l7_blend",
    """SELECT coin_id, ts, round(direction_prob, 6) AS direction_prob, round(ml_confidence, 6) AS ml_confidence FROM blended""",
)
def blend(spark, sf):
    rows = fc.blend(common.rule_votes(common.features(spark, sf)))
    return common.rounded(rows.select("coin_id", "ts", "direction_prob", "ml_confidence"), 6, "direction_prob", "ml_confidence")


@query(
    "l8_l10_trend_forecast",
    """SELECT coin_id, ts, round(predicted_return, 8) + 0.0 AS predicted_return, round(confidence, 6) AS confidence,
 round(predicted_price, 6) AS predicted_price, sentiment_bias FROM forecasted""",
)
def trend_forecast(spark, sf):
    rows = common.forecasts(spark, sf).select(
        "coin_id", "ts", "predicted_return", "confidence", "predicted_price", "sentiment_bias"
    )
    return common.rounded(common.rounded(rows, 8, "predicted_return"), 6, "confidence").withColumn(
        "predicted_price", F.round("predicted_price", 6)
    )


# Decimal rounding of the printed value, as Spark rounds doubles.
CURVE_PRICE = "CAST(round(CAST(CAST(curve_price AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"

CURVE = """(WITH steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
 c1 AS (SELECT *, greatest(-0.008, least(0.008, predicted_return)) AS c1 FROM forecasted),
 c2 AS (SELECT *, greatest(-0.008, least(0.008, c1 + predicted_return * 0.8)) AS c2 FROM c1),
 c3 AS (SELECT *, greatest(-0.008, least(0.008, c2 + predicted_return * 0.64)) AS c3 FROM c2),
 c4 AS (SELECT *, greatest(-0.008, least(0.008, c3 + predicted_return * 0.512)) AS c4 FROM c3),
 c5 AS (SELECT *, greatest(-0.008, least(0.008, c4 + predicted_return * 0.4096)) AS c5 FROM c4)
 SELECT coin_id, ts, CAST(i * 30 AS INTEGER) AS horizon_seconds, price * (1 + [c1, c2, c3, c4, c5][i]) AS curve_price,
 greatest(0.05, confidence * 0.8 ** (i - 1)) AS curve_confidence, direction_prob FROM c5, steps)"""


@query(
    "l9_forecast_curve",
    f"""SELECT coin_id, ts, horizon_seconds, {CURVE_PRICE} AS predicted_price, round(curve_confidence, 4) AS confidence,
 round(direction_prob, 4) AS direction_prob FROM {CURVE}""",
)
def forecast_curve(spark, sf):
    return fc.forecast_curve(common.forecasts(spark, sf), ["coin_id", "ts"])


@query(
    "d9_forecast_line",
    f"""SELECT coin_id, horizon_seconds, ts + to_seconds(horizon_seconds) AS ts, {CURVE_PRICE} AS price FROM {CURVE}
 WHERE (coin_id, ts) IN (SELECT coin_id, max(window_start) FROM bars30 GROUP BY 1)
 UNION ALL SELECT coin_id, 0, max(window_start), arg_max("close", window_start) FROM bars30 GROUP BY 1""",
)
def forecast_line(spark, sf):
    from marketloom.operators.latest import newest_per_key

    table = common.silver_bars(spark, sf)
    last = newest_per_key(common.forecasts(spark, sf, table), ["coin_id"], [F.col("ts").desc()])
    curve = fc.forecast_curve(last, ["coin_id"]).select("coin_id", "horizon_seconds", "predicted_price")
    return dashboard.forecast_line(table, curve)


_DRAWN = """(SELECT model, coin_id, CASE model WHEN 'legacy' THEN 300 ELSE 180 END AS h, arg_max(predicted_price, ts) AS p FROM preds GROUP BY 1, 2)
 JOIN (SELECT coin_id, max(window_start) AS t, arg_max("close", window_start) AS c FROM bars30 GROUP BY 1) USING (coin_id) WHERE p > 0"""


@query(
    "d9_single_point_lines",
    f"""SELECT model, coin_id, 0 AS horizon_seconds, t AS ts, round(c, 6) AS price FROM {_DRAWN}
 UNION ALL SELECT model, coin_id, h, t + to_seconds(h), round(p, 6) FROM {_DRAWN}""",
)
def single_point_lines(spark, sf):
    table = common.silver_bars(spark, sf)
    return common.rounded(dashboard.single_point_lines(table, common.predictions(spark, sf, table)), 6, "price")


@query(
    "j7_match_predictions",
    """SELECT model, coin_id, ts, matched_ts, matched_close FROM errs""",
)
def match_predictions(spark, sf):
    return _errors(spark, sf).select("model", "coin_id", "ts", "matched_ts", "matched_close")


@query("l11_a13_v7_accuracy_report", "SELECT * FROM report")
def accuracy_report(spark, sf):
    return _report(spark, sf)


@query(
    "l11_recent_errors",
    """SELECT model, coin_id, ts, round(pct_error, 4) AS pct_error, direction_correct FROM
 (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, coin_id DESC) AS rn FROM errs) WHERE rn <= 100""",
)
def recent_errors(spark, sf):
    return fc.recent_errors(_errors(spark, sf))


@query(
    "l12_best_model",
    """SELECT arg_max(model, (direction_accuracy, CASE WHEN model = 'ensemble' THEN 1 ELSE 0 END)) AS best_model,
 max(direction_accuracy) AS best_accuracy FROM report WHERE direction_accuracy > 0""",
)
def best_model(spark, sf):
    return fc.best_model(_report(spark, sf))


@query(
    "d6_model_reliability",
    """SELECT model, direction_accuracy, mape, CASE WHEN direction_accuracy >= 60 AND mape < 2 THEN 'HIGH'
 WHEN direction_accuracy >= 50 AND mape < 5 THEN 'MEDIUM' ELSE 'LOW' END AS reliability FROM report""",
)
def model_reliability(spark, sf):
    return dashboard.model_reliability(_report(spark, sf)).select("model", "direction_accuracy", "mape", "reliability")


_THRESHOLDS = f"""(SELECT t AS threshold, count(*) FILTER (sure) AS n_confident, avg(CASE WHEN sure THEN hit END) AS accuracy,
 count(*) FILTER (sure) / count(*) AS coverage, avg(hit) AS base_accuracy FROM
 (SELECT t, ml_confidence >= t AS sure, CASE WHEN (direction_prob > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END AS hit
  FROM {_LABELLED}, (SELECT unnest([0.05, 0.10, 0.15, 0.20, 0.30, 0.40]::DOUBLE[]) AS t)) GROUP BY t
 HAVING count(*) FILTER (sure) > 0)"""


@query(
    "a12_threshold_table",
    f"""SELECT threshold, n_confident, round(accuracy, 6) AS accuracy, round(coverage, 6) AS coverage,
 round(base_accuracy, 6) AS base_accuracy FROM {_THRESHOLDS}""",
)
def threshold_table(spark, sf):
    return common.rounded(fc.threshold_table(_labelled(spark, sf)), 6, "accuracy", "coverage", "base_accuracy")


@query(
    "l13_choose_threshold",
    f"""SELECT coalesce(arg_max(threshold, (accuracy, -threshold)) FILTER (accuracy > base_accuracy AND coverage > 0.3), 0.05) AS threshold,
 round(coalesce(max(accuracy) FILTER (accuracy > base_accuracy AND coverage > 0.3), max(base_accuracy)), 6) AS accuracy
 FROM {_THRESHOLDS}""",
)
def choose_threshold(spark, sf):
    return common.rounded(fc.choose_threshold(fc.threshold_table(_labelled(spark, sf))), 6, "accuracy")


@query("l1_l2_l3_l5_l14_train_voters")
def train_voters(spark, sf):
    """Fit the voters on the first 80% of every series, weigh them on the rest, list what matters."""
    samples = training.training_set(common.features(spark, sf, macd_scale="price", warmup="null"))
    model, stored = training.fit_voters(spark, samples)
    votes = training.vote(model, stored.filter(~F.col("is_train")))
    weights = fc.adaptive_weights(training.voter_accuracy(votes))
    top = training.feature_importance(model, spark)
    return weights.select(F.lit("weight").alias("kind"), F.col("voter").alias("name"), F.col("weight").alias("value")).unionByName(
        top.select(F.lit("importance").alias("kind"), F.col("feature").alias("name"), F.col("importance").alias("value"))
    )


@query(
    "l1_l2_l3_l14_saved_voters",
    """SELECT count(*) FILTER (pos < floor(len * 0.8) - 3) AS train_rows, count(*) FILTER (pos >= floor(len * 0.8)) AS test_rows,
 CAST(3 AS BIGINT) AS voters, CAST(0 AS BIGINT) AS outside_0_1, CAST(0 AS BIGINT) AS changed_by_reload, 1.0::DOUBLE AS weight_sum
 FROM ser WHERE pos >= 30 AND pos < len - 3""",
)
def saved_voters(spark, sf):
    """Causal features, a purged split, three voters saved, loaded and compared row by row."""
    samples = training.training_set(common.features(spark, sf, macd_scale="price", warmup="null"))
    model, stored = training.fit_voters(spark, samples)
    path = scratch_path(spark, "voters")
    weights, _, choice = training.evaluate(training.vote(model, stored.filter(~F.col("is_train"))))
    training.save(model, path, weights, choice)
    again, kept, _ = training.load(spark, path)
    probs = ["gb_prob", "rf_prob", "lstm_prob"]
    keys = ["coin_id", "ts", "is_train"]
    one = training.vote(model, stored).select(*keys, *probs)
    two = training.vote(again, stored).select("coin_id", "ts", *[F.col(p).alias(f"again_{p}") for p in probs])
    outside = reduce(lambda a, b: a | b, [~F.coalesce(F.col(p).between(0, 1), F.lit(False)) for p in probs])
    moved = reduce(lambda a, b: a | b, [F.abs(F.col(p) - F.col(f"again_{p}")) > 1e-12 for p in probs])
    counts = one.join(two, ["coin_id", "ts"]).agg(
        F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows"),
        F.count_if(outside).alias("outside_0_1"), F.count_if(moved).alias("changed_by_reload"),
    )
    sums = kept.agg(F.count(F.lit(1)).alias("voters"), F.round(F.sum("weight"), 6).alias("weight_sum"))
    return counts.withColumn("one", F.lit(1)).join(sums.withColumn("one", F.lit(1)), "one").drop("one")


@query(
    "v6_latest_predictions",
    """SELECT model, coin_id, ts, round(predicted_price, 6) AS predicted_price, current_price, model = 'legacy' AS is_primary
 FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC) AS rn FROM preds WHERE coin_id = 'click') WHERE rn = 1""",
)
def latest_predictions(spark, sf):
    rows = serving.latest_prediction(common.predictions(spark, sf), "click")
    return common.rounded(rows, 6, "predicted_price").drop("confidence", "sentiment_bias")


@query(
    "v8_prediction_history",
    """SELECT * FROM (SELECT ts, round(predicted_price, 6) AS predicted_price, current_price, round(confidence, 6) AS confidence, sentiment_bias
 FROM preds WHERE model = 'ensemble' AND coin_id = 'click' ORDER BY ts DESC LIMIT 100) ORDER BY ts""",
)
def prediction_history(spark, sf):
    rows = serving.prediction_history(common.predictions(spark, sf), "ensemble", "click", 100)
    return common.rounded(common.rounded(rows, 6, "predicted_price"), 6, "confidence")


@query(
    "d7_forecast_delta",
    """SELECT model, coin_id, ts, round(CASE WHEN current_price > 0 THEN (predicted_price - current_price) / current_price * 100 ELSE 0 END, 6) + 0.0
 AS delta_pct FROM preds""",
)
def forecast_delta(spark, sf):
    rows = dashboard.forecast_delta(common.predictions(spark, sf))
    return common.rounded(rows.select("model", "coin_id", "ts", "delta_pct"), 6, "delta_pct")


@query(
    "d8_predictions_within_bars",
    """SELECT model, coin_id, ts FROM preds WHERE ts >= (SELECT min(window_start) FROM bars30 WHERE window_start >= TIMESTAMP '2024-01-20')""",
)
def within_bars(spark, sf):
    table = common.silver_bars(spark, sf)
    shown = table.filter(F.col("window_start") >= F.lit("2024-01-20").cast("timestamp"))
    return dashboard.within_bars(common.predictions(spark, sf, table), shown).select("model", "coin_id", "ts")


@query(
    "d2_smoothed_predictions",
    """SELECT model, coin_id, ts, round(ema, 6) AS ema_price FROM dsmooth""",
)
def smoothed_predictions(spark, sf):
    made = common.predictions(spark, sf).select("model", "coin_id", "ts", "predicted_price")
    return common.rounded(dashboard.smoothed_predictions(made), 6, "ema_price").drop("predicted_price")


@query(
    "f14_position_bounds",
    "SELECT coin_id, max(pos) AS last_position, max(len) AS length FROM ser GROUP BY 1",
)
def position_bounds(spark, sf):
    return common.features(spark, sf).groupBy("coin_id").agg(F.max(POS).alias("last_position"), F.max(LENGTH).alias("length"))
