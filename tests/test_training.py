"""Blending, forecasting and fitting."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators.series import POS
from marketloom.plans import features as feat
from marketloom.plans import forecast as fc
from marketloom.plans import training
from marketloom.session import scratch_path
from tests.test_features import make_bars


def test_blend_renormalises_over_present_voters(spark):
    df = spark.createDataFrame([(0.9, 0.1, None), (None, None, None), (0.6, 0.6, 0.6)], "gb_prob double, rf_prob double, lstm_prob double")
    got = fc.blend(df).collect()
    assert got[0].direction_prob == pytest.approx((0.45 * 0.9 + 0.35 * 0.1) / 0.8)
    assert got[1].direction_prob is None
    assert got[2].ml_confidence == pytest.approx(0.2)


def test_curve_is_clipped_at_each_step(spark):
    df = spark.createDataFrame([(1, 100.0, 0.5, 0.7, 0.003)], "id int, price double, confidence double, direction_prob double, predicted_return double")
    got = fc.forecast_curve(df, ["id"]).orderBy("horizon_seconds").collect()
    assert [r.predicted_price for r in got] == [100.3, 100.54, 100.73, 100.8, 100.8]
    assert [r.horizon_seconds for r in got] == [30, 60, 90, 120, 150]
    assert [r.confidence for r in got] == [0.5, 0.4, 0.32, 0.256, 0.2048]


def test_weights_fall_back_when_no_voter_beats_a_coin(spark):
    df = spark.createDataFrame([("gb", 0.4), ("rf", 0.5), ("lstm", None)], "voter string, accuracy double")
    assert {r.voter: r.weight for r in fc.adaptive_weights(df).collect()} == {"gb": 0.33, "rf": 0.33, "lstm": 0.34}
    good = spark.createDataFrame([("gb", 0.6), ("rf", 0.7), ("lstm", 0.4)], "voter string, accuracy double")
    got = {r.voter: r.weight for r in fc.adaptive_weights(good).collect()}
    assert got == pytest.approx({"gb": 0.2, "rf": 0.8, "lstm": 0.0})


def test_threshold_needs_coverage(spark):
    rows = [(0.9, 0.8, 1.0)] * 2 + [(0.55, 0.1, 1.0)] * 4 + [(0.55, 0.1, 0.0)] * 4
    df = spark.createDataFrame(rows, "direction_prob double, ml_confidence double, label double")
    table = fc.threshold_table(df)
    assert {r.threshold: r.n_confident for r in table.collect()}[0.4] == 2
    assert tuple(fc.choose_threshold(table).first()) == (0.05, pytest.approx(0.6))


def test_ensemble_wins_ties(spark):
    df = spark.createDataFrame([("legacy", 5, 60.0), ("ensemble", 5, 60.0)], "model string, total_evaluated long, direction_accuracy double")
    assert tuple(fc.best_model(df).first()) == ("ensemble", 60.0)
    assert fc.best_model(df.withColumn("direction_accuracy", F.lit(0.0))).first().best_model is None


def test_errors_of_matched_predictions(spark):
    t = dt.datetime(2024, 1, 1)
    preds = spark.createDataFrame(
        [("m", "a", t, 11.0, 10.0), ("m", "b", t, 11.0, 10.0)],
        "model string, coin_id string, ts timestamp, predicted_price double, current_price double",
    )
    bars = spark.createDataFrame([("a", t + dt.timedelta(seconds=90), 10.5)], "coin_id string, ts timestamp, close double")
    errors = fc.prediction_errors(fc.match_predictions(preds, bars))
    row = errors.first()
    assert errors.count() == 1 and row.abs_error == 0.5 and row.direction_correct
    assert fc.accuracy_report(errors).first().mape == pytest.approx(4.7619)


def test_fit_vote_evaluate_and_save(spark, monkeypatch):
    boosting, forest = training.boosting, training.forest
    monkeypatch.setattr(training, "boosting", lambda n: boosting(n).setMaxIter(5))
    monkeypatch.setattr(training, "forest", lambda n: forest(n).setNumTrees(10))
    bars, _ = make_bars(spark, 300)
    samples = training.training_set(feat.build_features(bars))
    model, stored = training.fit_voters(spark, samples)
    votes = training.vote(model, stored.filter("not is_train")).cache()
    assert votes.count() > 0
    bad = votes.filter("gb_prob not between 0 and 1 or rf_prob not between 0 and 1 or lstm_prob not between 0 and 1")
    assert bad.count() == 0
    weights, table, choice = training.evaluate(votes)
    assert weights.agg(F.sum("weight")).first()[0] == pytest.approx(1.0)
    assert 0.05 <= choice.first().threshold <= 0.4
    assert training.feature_importance(model, spark).count() == 5
    path = scratch_path(spark, "model")
    training.save(model, path, weights, choice)
    again, kept, _ = training.load(spark, path)
    assert kept.count() == 3
    one = training.vote(again, stored.limit(5)).select("gb_prob").collect()
    assert len(one) == 5
    monkeypatch.setattr(training, "FEATURES", training.FEATURES[::-1])
    with pytest.raises(ValueError):
        training.load(spark, path)


def test_splits(spark):
    bars, _ = make_bars(spark, 200)
    rows = training.time_split(feat.training_samples(feat.build_features(bars)))
    latest_train = rows.filter("is_train").groupBy("coin_id").agg(F.max("ts").alias("t"))
    first_test = rows.filter("not is_train").groupBy("coin_id").agg(F.min("ts").alias("s"))
    assert latest_train.join(first_test, "coin_id").filter("t >= s").count() == 0
    ends = rows.groupBy("coin_id").agg(F.max(F.when(F.col("is_train"), F.col(POS))).alias("a"), F.min(F.when(~F.col("is_train"), F.col(POS))).alias("b"))
    assert {r.b - r.a for r in ends.collect()} == {4}, "labels of training rows must not reach the test rows"
    hashed = training.hash_split(rows, ["coin_id", "ts"])
    share = hashed.agg(F.avg(F.col("is_train").cast("int"))).first()[0]
    assert 0.7 < share < 0.9
    same = training.hash_split(rows.repartition(3), ["coin_id", "ts"])
    assert same.exceptAll(hashed).count() == 0
