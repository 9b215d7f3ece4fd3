"""Streaming jobs run over the test tables to completion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketloom.plans import features as feat
from marketloom.plans import forecast as fc
from marketloom.queries import common
from marketloom.queries.forecasts import CURVE, CURVE_PRICE
from marketloom.queries.registry import query
from marketloom.session import scratch_path, staged
from marketloom.sources import stand_ins, trades
from marketloom.streaming import jobs


def drain(spark: SparkSession, start: Callable[[], StreamingQuery]) -> None:
    """Run an available-now job to its end; the session sets the number of state partitions."""
    start().awaitTermination()


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = stand_ins.table(spark, sf, "events").schema
    return jobs.file_source(spark, sf, schema, pathGlobFilter="events.parquet")


@query(
    "t1_s4_s7_stream_ingest",
    """SELECT coin_id, symbol, price_usd, quantity, trade_time_ms, event_time_ms, is_buyer_maker,
 TIMESTAMP '2024-01-31 00:00:00' AS _spark_ingested_at FROM trades""",
)
def stream_ingest(spark, sf):
    """Topic files to the bronze table through an append job."""
    topic, table, marks = (scratch_path(spark, n) for n in ("topic", "bronze", "marks"))
    trades.to_topic(stand_ins.bronze_trades(spark, sf)).write.parquet(topic)
    raw = jobs.file_source(spark, topic, spark.read.parquet(topic).schema)
    bronze = jobs.ingest_trades(raw, common.as_of_time())
    drain(spark, lambda: jobs.append_sink(bronze, table, marks, available_now=True))
    return spark.read.parquet(table).drop("ingested_at", "source")


_BAR = """coin_id, window_start, window_end, round(vwap, 9) AS vwap, total_volume, round(avg_price, 9) AS avg_price,
 round(stddev_price, 9) AS stddev_price, open, high, low, "close", round(z_score, 9) + 0.0 AS z_score, is_anomaly"""


@query(
    "t2_t3_t4_t5_t6_t7_stream_bars_append",
    f"SELECT {_BAR} FROM bars30 WHERE window_end <= (SELECT max(t) - INTERVAL '1 minute' FROM trades)",
)
def stream_bars_append(spark, sf):
    """Bars in append mode: those still open behind the watermark are not written."""
    table, marks = scratch_path(spark, "bars"), scratch_path(spark, "marks")
    bars = jobs.stream_bars(stand_ins.trades_of_events(event_stream(spark, sf)))
    with jobs.low_latency(spark):
        drain(spark, lambda: jobs.append_sink(bars, table, marks, ["coin_id"], available_now=True))
    rows = spark.read.parquet(table)
    return common.rounded(rows, 9, "vwap", "avg_price", "stddev_price", "z_score")


@query("t4_t6_stream_bars_upsert", f"SELECT {_BAR} FROM bars30")
def stream_bars_upsert(spark, sf):
    """Bars merged as they change: equal to the batch bars, open ones included."""
    table, marks = scratch_path(spark, "bars"), scratch_path(spark, "marks")
    bars = jobs.stream_bars(stand_ins.trades_of_events(event_stream(spark, sf)))
    drain(spark, lambda: jobs.upsert_sink(bars, table, marks, available_now=True))
    rows = spark.read.parquet(table).drop("bar_day")
    return common.rounded(rows, 9, "vwap", "avg_price", "stddev_price", "z_score")


def _bar_files(spark, bars) -> str:
    path = scratch_path(spark, "silver-bars")
    bars.write.parquet(path)
    return path


@query(
    "t8_stream_scoring",
    """SELECT coin_id, window_start, round(predicted_return, 8) + 0.0 AS predicted_return, sentiment_bias
 FROM (SELECT *, ts AS window_start FROM forecasted)""",
)
def stream_scoring(spark, sf):
    """Bars arrive in five files, one per micro-batch: each is scored once, as one batch over all would."""
    made = common.silver_bars(spark, sf)
    history = scratch_path(spark, "silver-bars")
    share = F.percent_rank().over(Window.partitionBy("coin_id").orderBy("window_start"))
    cut = staged(made.withColumn("_file", F.least(F.floor(share * 5), F.lit(4))), "cut-bars")
    for part in range(5):
        cut.filter(F.col("_file") == part).drop("_file").coalesce(1).write.mode("append").parquet(history)
    out, marks = scratch_path(spark, "scores"), scratch_path(spark, "marks")
    sentiment = common.sentiment(spark, sf)

    def score(window: DataFrame, new: DataFrame) -> DataFrame:
        made = fc.trend_forecast(fc.blend(common.rule_votes(feat.build_features(window, sentiment))))
        rows = made.withColumnRenamed("ts", "window_start")
        return rows.join(new, ["coin_id", "window_start"], "left_semi").select(
            "coin_id", "window_start", "predicted_return", "sentiment_bias"
        )

    bars = jobs.file_source(spark, history, spark.read.parquet(history).schema, maxFilesPerTrigger="1")
    drain(spark, lambda: jobs.score_sink(bars, history, out, marks, score, available_now=True))
    return common.rounded(spark.read.parquet(out).drop("batch"), 8, "predicted_return")


@query(
    "t8_curve",
    f"""SELECT coin_id, ts, horizon_seconds, {CURVE_PRICE} AS predicted_price, round(curve_confidence, 4) AS confidence,
 round(direction_prob, 4) AS direction_prob FROM {CURVE} WHERE (coin_id, ts) IN (SELECT coin_id, max(window_start) FROM bars30 GROUP BY 1)""",
)
def stream_curve(spark, sf):
    """The curve refreshed in every fifth micro-batch: six parts by time, the job started anew for each."""
    made = staged(common.silver_bars(spark, sf), "curve-bars")
    lasts = made.groupBy("coin_id").agg(F.min("window_start").alias("_first"), F.max("window_start").alias("_last"))
    at, start, end = (F.unix_seconds(c) for c in ("window_start", "_first", "_last"))
    parts = made.join(lasts, "coin_id").withColumn("_part", F.floor((at - start) * 6 / (end - start + 1))).drop("_first", "_last")
    history, out, marks = (scratch_path(spark, n) for n in ("silver-bars", "scores", "marks"))
    sentiment = common.sentiment(spark, sf)

    def forecast(window: DataFrame, wanted: DataFrame) -> DataFrame:
        rows = fc.trend_forecast(fc.blend(common.rule_votes(feat.build_features(window, sentiment))))
        return rows.join(wanted.withColumnRenamed("window_start", "ts"), ["coin_id", "ts"], "left_semi")

    def score(window: DataFrame, new: DataFrame) -> DataFrame:
        return forecast(window, new).select("coin_id", "ts", "predicted_return")

    def curve(window: DataFrame, latest: DataFrame) -> DataFrame:
        return fc.forecast_curve(forecast(window, latest), ["coin_id", "ts"])

    for part in range(6):
        parts.filter(F.col("_part") == part).drop("_part").write.mode("append").parquet(history)
        bars = jobs.file_source(spark, history, made.schema)
        drain(spark, lambda: jobs.score_sink(bars, history, out, marks, score, available_now=True, curve=curve))
    return jobs.latest_curve(spark, out)


@query(
    "t9_stream_match",
    """SELECT model, coin_id, ts, matched_ts, matched_close FROM errs""",
)
def stream_match(spark, sf):
    """Predictions joined to later bars as two streams, the earliest bar kept per prediction."""
    bars_path, preds_path = _bar_files(spark, common.bars(spark, sf)), scratch_path(spark, "preds")
    common.predictions(spark, sf, spark.read.parquet(bars_path)).write.parquet(preds_path)
    out, marks = scratch_path(spark, "pairs"), scratch_path(spark, "marks")
    preds = jobs.file_source(spark, preds_path, spark.read.parquet(preds_path).schema)
    bars = jobs.file_source(spark, bars_path, spark.read.parquet(bars_path).schema)
    pairs = jobs.match_stream(preds, bars)
    drain(spark, lambda: jobs.append_sink(pairs, out, marks, available_now=True))
    return jobs.first_match(spark.read.parquet(out)).select("model", "coin_id", "ts", "matched_ts", "matched_close")


def _slices(df: DataFrame, at: str, label: str, count: int = 4) -> list[DataFrame]:
    """The rows cut by time into slices of equal length, whatever asset they are of."""
    cut = staged(df, label)
    first, last = cut.agg(F.unix_micros(F.min(at)), F.unix_micros(F.max(at))).first()
    if first is None:
        return [cut] * count
    share = (F.unix_micros(at) - F.lit(first)) / F.lit(max(1, last - first))
    numbered = cut.withColumn("_slice", F.least(F.floor(share * count), F.lit(count - 1)))
    return [numbered.filter(F.col("_slice") == i).select(*df.columns) for i in range(count)]


@query("t9_running_accuracy", "SELECT * FROM report")
def stream_accuracy(spark, sf):
    """Predictions and bars arrive in four slices; the job is restarted for each, and some predictions come twice.

    A last row far ahead on both sides, of an asset without a name, ends the streams: it moves the watermark past
    all others. (The join would drop a null asset before the watermark sees its row.)
    """
    bars = staged(common.bars(spark, sf).select("coin_id", "window_start", "close"), "stream-bars")
    made = common.predictions(spark, sf).select("model", "coin_id", "ts", "predicted_price", "current_price")
    preds_path, bars_path, out, marks = (scratch_path(spark, n) for n in ("preds", "bars", "accuracy", "marks"))
    ahead = F.expr("interval 1 day")
    preds = staged(made, "stream-preds")
    nowhere = F.lit("").alias("coin_id")
    end_preds = preds.agg((F.max("ts") + ahead).alias("ts")).select(F.lit("").alias("model"), nowhere, "ts", F.lit(0.0).alias("predicted_price"), F.lit(0.0).alias("current_price"))
    end_bars = bars.agg((F.max("window_start") + ahead).alias("window_start")).select(nowhere, "window_start", F.lit(0.0).alias("close"))
    parts = [*zip(_slices(preds, "ts", "preds"), _slices(bars, "window_start", "bars")), (end_preds, end_bars)]
    with jobs.low_latency(spark):
        for new_preds, new_bars in parts:
            # The newest predictions of a slice are delivered twice.
            again = new_preds.join(new_preds.agg(F.max("ts").alias("ts")), "ts", "left_semi")
            new_preds.unionByName(again.select(*new_preds.columns)).write.mode("append").parquet(preds_path)
            new_bars.write.mode("append").parquet(bars_path)
            streams = (jobs.file_source(spark, p, d.schema) for p, d in ((preds_path, preds), (bars_path, bars)))
            evaluated = jobs.evaluate_stream(*streams)
            drain(spark, lambda: jobs.accuracy_sink(evaluated, out, marks, available_now=True))
    return jobs.running_accuracy(spark, out)
