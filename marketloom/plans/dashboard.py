"""Data logic behind the dashboard panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.labels import change_class, matrix_signal, reliability, sentiment_band
from marketloom.operators.latest import newest_per_key
from marketloom.plans.features import smoothed
from marketloom.session import staged


def rebase(prices: DataFrame, keys: list[str] | None = None, base: float = 100.0) -> DataFrame:
    """Each price relative to the first of its series.

    The first prices, one row per series, are staged so that the planner knows their size.
    """
    keys = keys or ["coin_id"]
    first = staged(prices.groupBy(*keys).agg(F.min_by("price_usd", "price_date").alias("_first")), "first")
    normalized = F.try_divide(F.col("price_usd"), F.col("_first")) * base
    return prices.join(first, keys).withColumn("normalized", normalized).drop("_first")


def compare_assets(prices: DataFrame, a: str, b: str) -> DataFrame:
    """Two assets on a common base of 100, one row per date, with their volumes."""
    two = rebase(prices.filter(F.col("coin_id").isin(a, b)))
    side = F.when(F.col("coin_id") == a, "a").otherwise("b")
    return (
        two.withColumn("side", side)
        .groupBy("price_date")
        .pivot("side", ["a", "b"])
        .agg(F.max("normalized").alias("normalized"), F.max("volume_24h_usd").alias("volume"))
    )


def comparative_metrics(overview: DataFrame, a: str, b: str) -> DataFrame:
    return overview.filter(F.col("coin_id").isin(a, b)).fillna(0.0)


def smoothed_predictions(predictions: DataFrame, span: int = 5) -> DataFrame:
    """EMA of the predicted price per model and asset."""
    return smoothed(predictions, ["model", "coin_id"], "ts", "predicted_price", span, "ema_price")


def signal_matrix(overview: DataFrame, sentiment_value: Column) -> DataFrame:
    """Technical and combined class per asset."""
    change = F.col("price_change_24h_pct")
    return overview.select(
        F.upper("coin_id").alias("asset"),
        "current_price",
        F.coalesce(change, F.lit(0.0)).alias("change_pct"),
        change_class(change).alias("technical"),
        sentiment_value.alias("sentiment"),
        matrix_signal(sentiment_value, change).alias("combined"),
    )


def sentiment_bands(history: DataFrame) -> DataFrame:
    return history.withColumn("band", sentiment_band(F.col("value")))


def model_reliability(report: DataFrame) -> DataFrame:
    return report.withColumn("reliability", reliability(F.col("direction_accuracy"), F.col("mape")))


def forecast_delta(predictions: DataFrame) -> DataFrame:
    """Predicted change in percent, 0 where the current price is not positive."""
    current = F.col("current_price")
    delta = F.try_divide(F.col("predicted_price") - current, current) * 100
    return predictions.withColumn("delta_pct", F.when(current > 0, delta).otherwise(F.lit(0.0)))


def within_bars(predictions: DataFrame, bars: DataFrame) -> DataFrame:
    """Predictions not older than the first shown bar."""
    first = bars.agg(F.min("window_start").alias("m")).scalar()
    return predictions.filter(F.col("ts") >= first)


def forecast_line(bars: DataFrame, curve: DataFrame) -> DataFrame:
    """The last bar of each asset followed by its forecast points.

    curve: coin_id, horizon_seconds, predicted_price.
    """
    last = newest_per_key(bars, ["coin_id"], [F.col("window_start").desc()]).select(
        "coin_id", F.col("window_start").alias("_last"), F.col("close").alias("_close")
    )
    anchor = last.select("coin_id", F.lit(0).alias("horizon_seconds"), F.col("_last").alias("ts"), F.col("_close").alias("price"))
    ahead = curve.join(last, "coin_id").select(
        "coin_id",
        "horizon_seconds",
        F.timestamp_micros(F.unix_micros("_last") + F.col("horizon_seconds").cast("bigint") * 1000000).alias("ts"),
        F.col("predicted_price").alias("price"),
    )
    return anchor.unionByName(ahead)


# Where a prediction without a curve is drawn, in seconds behind the last bar.
SINGLE_POINT_SECONDS = {"legacy": 300, "ensemble": 180}


def single_point_lines(bars: DataFrame, predictions: DataFrame) -> DataFrame:
    """The last bar of each asset, and one point ahead for the newest positive prediction of each model."""
    last = newest_per_key(bars, ["coin_id"], [F.col("window_start").desc()]).select(
        "coin_id", F.col("window_start").alias("_last"), F.col("close").alias("_close")
    )
    newest = newest_per_key(predictions.select("model", "coin_id", "ts", "predicted_price"), ["model", "coin_id"], [F.col("ts").desc()])
    seconds = F.create_map(*[F.lit(x) for pair in SINGLE_POINT_SECONDS.items() for x in pair])[F.col("model")]
    drawn = newest.filter((F.col("predicted_price") > 0) & seconds.isNotNull()).join(last, "coin_id")
    ahead = F.timestamp_micros(F.unix_micros("_last") + seconds.cast("bigint") * 1000000)
    points = F.array(
        F.struct(F.lit(0).alias("horizon_seconds"), F.col("_last").alias("ts"), F.col("_close").alias("price")),
        F.struct(seconds.alias("horizon_seconds"), ahead.alias("ts"), F.col("predicted_price").alias("price")),
    )
    return drawn.select("model", "coin_id", F.explode(points).alias("p")).select("model", "coin_id", "p.*")


def display_table(overview: DataFrame) -> DataFrame:
    """NULL measures to 0 and the column titles of the overview panel."""
    titles = {
        "coin_id": "asset",
        "price_change_24h_pct": "change_24h_pct",
        "current_price": "price",
        "market_cap_usd": "market_cap",
        "volume_24h_usd": "volume_24h",
    }
    return overview.fillna(0.0).withColumnsRenamed(titles)
