"""Trade ingest and bar jobs.

Sources and sinks are format names with options, so the same job runs on a topic or on files.
A topic connector is not bundled; its options are the documented ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from marketloom.operators.bars import trade_ticks, vwap_bars
from marketloom.operators.latest import newest_per_key
from marketloom.operators.merge import create_if_missing, upsert
from marketloom.plans.features import REACH
from marketloom.plans.forecast import accuracy_of_sums, accuracy_sums, prediction_errors
from marketloom.session import drop_beside, path_exists, staged, unstage
from marketloom.sources.ingest import stamp
from marketloom.sources.trades import from_topic

WATERMARK = "1 minute"
# As far as any feature looks back: the slowest smoothing has forgotten what lies before.
LOOKBACK_ROWS = REACH
BAR_WIDTH = "30 seconds"
TRIGGER = "10 seconds"
# Few state partitions keep small micro-batches fast; raise it with the number of assets.
LOW_LATENCY_CONF = {"spark.sql.shuffle.partitions": "2"}


@contextmanager
def low_latency(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside get the low-latency settings; a checkpoint keeps its state partitions for life."""
    before = {k: spark.conf.get(k) for k in LOW_LATENCY_CONF}
    for k, v in LOW_LATENCY_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def topic_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .load()
    )


def topic_sink(keyed: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Write key and value to a topic; the key sends one asset to one topic partition."""
    return (
        keyed.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def file_source(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def ingest_trades(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Topic values to stamped bronze trades."""
    return stamp(from_topic(raw), as_of)


def stream_bars(trades: DataFrame, width: str = BAR_WIDTH, watermark: str = WATERMARK) -> DataFrame:
    """Bars over a stream of trades; rows later than the watermark are dropped."""
    ticks = trade_ticks(trades).withWatermark("trade_time", watermark)
    return vwap_bars(ticks, width)


def append_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    available_now: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Start an append job into a Parquet table."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def upsert_sink(
    bars: DataFrame, path: str, checkpoint: str, available_now: bool = False, trigger: str = TRIGGER
) -> StreamingQuery:
    """Start a job that merges every changed bar into the silver table as soon as it changes.

    Update mode emits open bars too, so the table is never a watermark behind. A repeated
    micro-batch merges the same keys again, which leaves the table as it was.
    """

    spark = bars.sparkSession
    keyed = bars.withColumn("bar_day", F.to_date("window_start"))
    create_if_missing(spark, path, keyed.schema, ["bar_day"])

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(spark, path, batch, ["coin_id", "window_start"], ["bar_day"], ["coin_id", "window_start"])

    writer = keyed.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(merge)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


TAIL, CURVE = "__tail", "__curve"


def bars_before(new: DataFrame, tail: DataFrame, past: Callable[[], DataFrame], lookback_rows: int) -> DataFrame:
    """The rows that new bars of a micro-batch need beside themselves: the tail of their assets, or ``past()``.

    ``tail`` holds the newest ``2 * lookback_rows`` bars of each asset met so far. That is enough unless an
    asset is not in it yet, or a bar is so late that a full tail has fewer than ``lookback_rows`` bars before
    it. Only for such assets ``past()``, the whole history, is read, so every bar has all its rows before it.
    """
    first = new.groupBy("coin_id").agg(F.min("window_start").alias("_first"))
    earlier = F.count_if(F.col("window_start") < F.col("_first"))
    of_tail = tail.join(first, "coin_id").groupBy("coin_id").agg(F.count("*").alias("_kept"), earlier.alias("_earlier"))
    state = first.join(of_tail, "coin_id", "left")
    enough = (F.col("_earlier") >= lookback_rows) | (F.col("_kept") < 2 * lookback_rows)
    short = state.filter(~F.coalesce(enough, F.lit(False))).select("coin_id", "_first")
    rows = tail.join(state.select("coin_id"), "coin_id", "left_semi")
    if not short.isEmpty():
        older = past().join(short, "coin_id").filter(F.col("window_start") < F.col("_first")).select(*tail.columns)
        newest = newest_per_key(older, ["coin_id"], [F.col("window_start").desc()], 2 * lookback_rows)
        rows = rows.unionByName(newest).dropDuplicates(["coin_id", "window_start"])
    return rows.join(new.select("coin_id", "window_start"), ["coin_id", "window_start"], "left_anti")


def score_sink(
    bars: DataFrame,
    history: str,
    path: str,
    checkpoint: str,
    score,
    lookback_rows: int = LOOKBACK_ROWS,
    available_now: bool = False,
    trigger: str = "30 seconds",
    curve: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    curve_every: int = 5,
) -> StreamingQuery:
    """Start a job that scores every new bar with at least the ``lookback_rows`` bars of its asset before it.

    A bounded table beside the output carries the newest bars of every asset from micro-batch to
    micro-batch, so the bars table ``history`` is not read again but for assets that are new and bars
    that are very late (``bars_before``). However far apart the bars are, they are found, and an asset
    with fewer has what it has, so no bar stays unscored. ``score(window, new)`` maps the bars needed,
    later ones of a late bar included, and the keys of the new ones to predictions.
    With features that look back a bounded number of rows (``macd_scale="price"``) it gives the same
    as one batch over all bars. Scores and tail are partitioned by micro-batch and overwritten on a
    repeat, which reads the tail of the batch before it again, so no bar is scored twice.

    ``curve(window, latest)`` maps the tail and the keys of the newest bar of every asset to future points.
    It is called in every ``curve_every``-th micro-batch, the first one included; ``latest_curve`` reads the result.
    """
    columns = ["coin_id", "window_start", "close", "total_volume"]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = staged(batch.select(*columns), "new-bars")
        before = f"{path}{TAIL}/batch={batch_id - 1}"
        if path_exists(spark, f"{before}/_SUCCESS"):
            tail = spark.read.schema(new.schema).parquet(before)
        else:
            tail = spark.createDataFrame([], new.schema)
        rows = bars_before(new, tail, lambda: spark.read.parquet(history).select(*columns), lookback_rows)
        window = staged(rows.unionByName(new), "scoring-window")
        untouched = tail.join(new.select("coin_id").distinct(), "coin_id", "left_anti")
        newest = newest_per_key(window, ["coin_id"], [F.col("window_start").desc()], 2 * lookback_rows)
        untouched.unionByName(newest).write.mode("overwrite").parquet(f"{path}{TAIL}/batch={batch_id}")
        if not new.isEmpty():
            scored = score(window, new.select("coin_id", "window_start"))
            scored.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if curve and batch_id % curve_every == 0:
            kept = spark.read.schema(new.schema).parquet(f"{path}{TAIL}/batch={batch_id}")
            latest = kept.groupBy("coin_id").agg(F.max("window_start").alias("window_start"))
            curve(kept, latest).write.mode("overwrite").parquet(f"{path}{CURVE}/batch={batch_id}")
        if batch_id > 1:  # a repeat of this batch needs the tail before it, nothing needs older ones
            drop_beside(spark, path, f"{TAIL}/batch={batch_id - 2}")
        unstage(window)
        unstage(new)

    writer = bars.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(run)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def latest_curve(spark: SparkSession, path: str) -> DataFrame:
    """The curve that was refreshed last, as one whole: partitions of the others are not read."""
    made = spark.read.parquet(f"{path}{CURVE}")
    newest = made.agg(F.max("batch").alias("batch"))
    return made.join(newest, "batch").drop("batch")


def match_stream(
    predictions: DataFrame, bars: DataFrame, min_age_s: int = 60, max_age_s: int = 300, watermark: str = WATERMARK
) -> DataFrame:
    """Predictions with the bars that fall into their evaluation range, as a stream-stream join.

    Both sides are keyed by asset and time bucket, as wide as the range: a prediction probes two
    buckets instead of all buffered bars of its asset. Both are watermarked and the range bounds
    the join, so state expires by itself. ``first_match`` keeps the earliest bar of a prediction.
    """
    return _in_range(predictions.withWatermark("ts", watermark), bars, min_age_s, max_age_s, watermark)


def _in_range(predictions: DataFrame, bars: DataFrame, min_age_s: int, max_age_s: int, watermark: str) -> DataFrame:
    width = max_age_s - min_age_s
    first = F.floor((F.unix_seconds("ts") + min_age_s) / width)
    p = predictions.select("model", "coin_id", "ts", "predicted_price", "current_price")
    p = p.withColumn("probe", F.explode(F.array(first, first + 1)))
    b = bars.select(
        F.col("coin_id").alias("bar_coin"), F.col("window_start").alias("bar_ts"), F.col("close").alias("bar_close")
    ).withWatermark("bar_ts", watermark)
    b = b.withColumn("bucket", F.floor(F.unix_seconds("bar_ts") / width))
    in_range = (
        (F.col("coin_id") == F.col("bar_coin"))
        & (F.col("probe") == F.col("bucket"))
        & (F.col("bar_ts") >= F.col("ts") + F.expr(f"interval {min_age_s} seconds"))
        & (F.col("bar_ts") <= F.col("ts") + F.expr(f"interval {max_age_s} seconds"))
    )
    return p.join(b, in_range).drop("bar_coin", "probe", "bucket")


def evaluate_stream(
    predictions: DataFrame, bars: DataFrame, min_age_s: int = 60, max_age_s: int = 300, watermark: str = WATERMARK
) -> DataFrame:
    """Every prediction with its earliest bar in range, once, as three chained stateful operators.

    Repeated predictions go first: their keys are remembered for ``max_age_s`` behind the watermark, and what comes
    still later is late. The range join follows, and an aggregate that keeps the earliest bar of a prediction until
    the watermark says that no earlier one can come. All three drop their state by the watermark. The time
    of a bar is carried as a number, so that the time of the prediction alone is the event time behind the join.
    """
    keys = ["model", "coin_id", "ts"]
    once = predictions.withWatermark("ts", f"{max_age_s} seconds").dropDuplicatesWithinWatermark(keys)
    pairs = _in_range(once, bars, min_age_s, max_age_s, watermark).withColumn("bar_us", F.unix_micros("bar_ts")).drop("bar_ts")
    return pairs.groupBy(*keys, "predicted_price", "current_price").agg(
        F.min("bar_us").alias("bar_us"), F.min_by("bar_close", "bar_us").alias("matched_close")
    ).select(*keys, "predicted_price", "current_price", F.timestamp_micros("bar_us").alias("matched_ts"), "matched_close")


def accuracy_sink(
    evaluated: DataFrame, path: str, checkpoint: str, available_now: bool = False, trigger: str = TRIGGER
) -> StreamingQuery:
    """Start a job that adds up the errors of every micro-batch; ``running_accuracy`` reads the sums.

    A micro-batch leaves one row per model under its own number and replaces it when it is repeated,
    so an evaluation counts once whatever fails.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        accuracy_sums(prediction_errors(batch)).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = evaluated.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(add)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def running_accuracy(spark: SparkSession, path: str) -> DataFrame:
    """Accuracy of each model over all predictions evaluated so far."""
    return accuracy_of_sums(spark.read.parquet(path))


def first_match(pairs: DataFrame) -> DataFrame:
    """The earliest bar of each prediction from the appended pairs: one evaluation per prediction."""
    return pairs.groupBy("model", "coin_id", "ts", "predicted_price", "current_price").agg(
        F.min("bar_ts").alias("matched_ts"), F.min_by("bar_close", "bar_ts").alias("matched_close")
    )
