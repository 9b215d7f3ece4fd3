"""Blending voters, forecasting, and scoring predictions against later prices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.labels import bias
from marketloom.functions.numbers import clip
from marketloom.operators.latest import newest_per_key
from marketloom.operators.match import first_in_range
from marketloom.session import staged

VOTERS = ["gb", "rf", "lstm"]
# Default voter weights and confidence thresholds.
DEFAULT_WEIGHTS = {"gb": 0.45, "rf": 0.35, "lstm": 0.20}
EVEN_WEIGHTS = {"gb": 0.33, "rf": 0.33, "lstm": 0.34}
THRESHOLDS = [0.05, 0.10, 0.15, 0.20, 0.30, 0.40]
MIN_COVERAGE = 0.30


def adaptive_weights(accuracies: DataFrame) -> DataFrame:
    """Weights (accuracy - 0.5)^2 above 0.5, normalised; even weights when no voter beats a coin.

    ``accuracies`` has one row per voter: voter, accuracy.
    """
    raw = F.when(F.col("accuracy") > 0.5, F.pow(F.col("accuracy") - 0.5, F.lit(2.0))).otherwise(F.lit(0.0))
    scored = staged(accuracies.withColumn("raw", raw), "accuracies")
    total = scored.agg(F.sum("raw").alias("t")).scalar()
    even = F.create_map(*[F.lit(x) for item in EVEN_WEIGHTS.items() for x in item])
    weight = F.when(total > 0, F.col("raw") / total).otherwise(F.try_element_at(even, F.col("voter")))
    return scored.select("voter", "accuracy", weight.alias("weight"))


def blend(votes: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Probability of a rise over the voters present, their weights renormalised, and the confidence."""
    weights = weights or DEFAULT_WEIGHTS

    def total(term) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.col(f"{v}_prob").isNotNull(), term(v)).otherwise(F.lit(0.0)) for v in VOTERS])

    active = total(lambda v: F.lit(float(weights[v])))
    mix = total(lambda v: F.lit(float(weights[v])) * F.col(f"{v}_prob"))
    prob = F.when(active > 0, mix / F.when(active > 0, active))
    return votes.withColumn("direction_prob", prob).withColumn("ml_confidence", F.abs(F.col("direction_prob") - 0.5) * 2)


def trend_forecast(df: DataFrame) -> DataFrame:
    """Predicted return and confidence of every bar: the voters give the direction, momentum the size.

    Needs direction_prob, ml_confidence, trend_momentum, recent_vol, rsi_7, bb_position and price.
    """
    up = F.col("direction_prob") > 0.5
    momentum = F.col("trend_momentum")
    strength = F.least(F.abs(momentum) / F.lit(0.002), F.lit(1.0))
    rsi, band = F.col("rsi_7") * 100, F.col("bb_position")
    reversion = (
        F.when((rsi > 70) | (band > 0.9), F.lit(-0.3)).when((rsi < 30) | (band < 0.1), F.lit(0.3)).otherwise(F.lit(0.0))
    )
    base = (
        F.when(up, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.greatest("recent_vol", F.lit(0.0001))
        * (F.lit(0.3) + F.lit(0.7) * F.col("ml_confidence"))
    )
    agrees = (momentum > 0) == up
    factor = (
        F.when(agrees & (strength > 0.2), F.lit(1.0) + F.lit(0.3) * strength)
        .when(~agrees & (strength > 0.3), F.greatest(F.lit(0.3), F.lit(1.0) - F.lit(0.5) * strength))
        .otherwise(F.lit(1.0))
    )
    expected = clip(base * factor + reversion * F.abs(momentum), -0.003, 0.003)
    confidence = F.greatest(F.lit(0.1), strength * 0.6 + F.col("ml_confidence") * 0.4)
    out = df.withColumns(
        {
            "continuation_factor": factor,
            "mean_reversion": reversion,
            "predicted_return": expected,
            "confidence": confidence,
        }
    )
    target = F.col("price") * (F.lit(1.0) + F.col("predicted_return"))
    return out.withColumn("predicted_price", target).withColumn(
        "sentiment_bias", bias(F.col("predicted_price"), F.col("price"))
    )


def forecast_curve(forecast: DataFrame, keep: list[str], points: int = 5, step_s: int = 30) -> DataFrame:
    """Future points of every forecast: returns decay by 0.8 and their running sum is clipped at each step."""
    steps = F.sequence(F.lit(1), F.lit(points))
    curve = F.aggregate(
        steps,
        F.array(F.lit(0.0)),
        lambda acc, i: F.concat(
            acc,
            F.array(clip(F.element_at(acc, -1) + F.col("predicted_return") * F.pow(F.lit(0.8), i - 1), -0.008, 0.008)),
        ),
    )
    exploded = forecast.select(
        *keep, "price", "confidence", "direction_prob", F.posexplode(F.slice(curve, 2, points)).alias("pos", "total_return")
    )
    decayed = F.col("confidence") * F.pow(F.lit(0.8), F.col("pos"))
    return exploded.select(
        *keep,
        ((F.col("pos") + 1) * step_s).alias("horizon_seconds"),
        F.round(F.col("price") * (F.lit(1.0) + F.col("total_return")), 2).alias("predicted_price"),
        F.round(F.greatest(decayed, F.lit(0.05)), 4).alias("confidence"),
        F.round("direction_prob", 4).alias("direction_prob"),
    )


# Evaluation -----------------------------------------------------------------------------


def match_predictions(
    predictions: DataFrame, bars: DataFrame, min_age_s: float = 60, max_age_s: float = 300
) -> DataFrame:
    """Each prediction with the earliest bar between ``min_age_s`` and ``max_age_s`` after it.

    predictions: model, coin_id, ts, predicted_price, current_price; bars: coin_id, ts, close.
    """
    return first_in_range(
        predictions, bars, ["coin_id"], "ts", "ts", min_age_s, max_age_s, ["model", "coin_id", "ts"], ["close"]
    )


def prediction_errors(matched: DataFrame) -> DataFrame:
    """Absolute and percentage error and direction match of the evaluated predictions."""
    actual, predicted, start = F.col("matched_close"), F.col("predicted_price"), F.col("current_price")
    error = F.abs(predicted - actual)
    return matched.filter(actual.isNotNull()).withColumns(
        {
            "abs_error": error,
            "pct_error": F.try_divide(error, actual) * 100,
            "direction_correct": (predicted > start) == (actual > start),
        }
    )


def accuracy_report(errors: DataFrame, by: list[str] | None = None) -> DataFrame:
    hit = F.col("direction_correct").cast("double")
    return errors.groupBy(*(by or ["model"])).agg(
        F.count(F.lit(1)).alias("total_evaluated"),
        F.round(F.avg("abs_error"), 2).alias("mae"),
        F.round(F.avg("pct_error"), 4).alias("mape"),
        F.round(F.avg(hit) * 100, 1).alias("direction_accuracy"),
        F.count_if("direction_correct").alias("correct_direction"),
    )


def accuracy_sums(errors: DataFrame, by: list[str] | None = None) -> DataFrame:
    """What ``accuracy_of_sums`` needs of some errors; rows of several such tables add up."""
    return errors.groupBy(*(by or ["model"])).agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.sum("abs_error").alias("abs_error"),
        F.count("abs_error").alias("abs_rows"),
        F.sum("pct_error").alias("pct_error"),
        F.count("pct_error").alias("pct_rows"),
        F.count_if("direction_correct").alias("correct"),
        F.count("direction_correct").alias("direction_rows"),
    )


def accuracy_of_sums(sums: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``accuracy_report`` of all errors that were added up."""
    mean = lambda value, rows: F.try_divide(F.sum(value), F.sum(rows))
    return sums.groupBy(*(by or ["model"])).agg(
        F.sum("evaluated").alias("total_evaluated"),
        F.round(mean("abs_error", "abs_rows"), 2).alias("mae"),
        F.round(mean("pct_error", "pct_rows"), 4).alias("mape"),
        F.round(mean("correct", "direction_rows") * 100, 1).alias("direction_accuracy"),
        F.sum("correct").alias("correct_direction"),
    )


def recent_errors(errors: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest errors of each model."""
    order = [F.col("ts").desc(), F.col("coin_id").desc()]
    return newest_per_key(errors, ["model"], order, n).select(
        "model", "coin_id", "ts", F.round("pct_error", 4).alias("pct_error"), "direction_correct"
    )


def best_model(report: DataFrame) -> DataFrame:
    """The model with the highest direction accuracy above zero; the ensemble wins ties."""
    rank = F.struct("direction_accuracy", (F.col("model") == "ensemble").cast("int"), "model")
    scored = report.filter((F.col("total_evaluated") > 0) & (F.col("direction_accuracy") > 0))
    return scored.agg(
        F.max_by("model", rank).alias("best_model"), F.max("direction_accuracy").alias("best_accuracy")
    )


def threshold_table(predictions: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """Accuracy and coverage of predictions at or above each confidence threshold, in one pass.

    predictions: direction_prob, ml_confidence, label.
    """
    thresholds = thresholds or THRESHOLDS
    right = ((F.col("direction_prob") > 0.5).cast("double") == F.col("label")).cast("double")
    sure = [F.col("ml_confidence") >= t for t in thresholds]
    wide = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(right).alias("base_accuracy"),
        *[F.count_if(s).alias(f"n{i}") for i, s in enumerate(sure)],
        *[F.avg(F.when(s, right)).alias(f"a{i}") for i, s in enumerate(sure)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"n{i}").alias("n_confident"),
                F.col(f"a{i}").alias("accuracy"),
                F.try_divide(f"n{i}", "n").alias("coverage"),
                F.col("base_accuracy").alias("base_accuracy"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*").filter(F.col("n_confident") > 0)


def choose_threshold(table: DataFrame) -> DataFrame:
    """The threshold of the best accuracy above the unfiltered one at sufficient coverage.

    Ties go to the lower threshold; without a better one the lowest threshold stands.
    """
    better = (F.col("accuracy") > F.col("base_accuracy")) & (F.col("coverage") > MIN_COVERAGE)
    rank = F.when(better, F.struct(F.col("accuracy"), -F.col("threshold")))
    return table.agg(
        F.coalesce(F.max_by("threshold", rank), F.lit(THRESHOLDS[0])).alias("threshold"),
        F.coalesce(F.max(F.when(better, F.col("accuracy"))), F.max("base_accuracy")).alias("accuracy"),
    )
