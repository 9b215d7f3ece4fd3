"""Bars kept up to date from the files of a bronze trade table.

Which files a load has read is known from the log of a file stream, not from any clock: a file that is
committed late, with whatever stamps, is a file that was not read yet. The new rows become one state per asset
and hour (sums, count, extremes, first and last tick), written beside the table under the number of the
micro-batch. States merge, so a late trade needs no second read of its period: the touched periods are made
from the states of all batches, and upserted.

A micro-batch that is repeated after a failure overwrites its own states and makes the same bars again.
The table, ``__states`` and ``__progress`` belong together: without them the next load starts anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.bars import hour_states, hourly_of_states, merged_states, ohlc_of_states, trade_ticks
from marketloom.operators.merge import recover, touched_rows, upsert
from marketloom.session import path_exists

TRADE_COLUMNS = "coin_id string, price_usd double, quantity double, trade_time_ms long"


def _load(
    spark: SparkSession,
    path: str,
    bronze: str,
    build: Callable[[DataFrame], DataFrame],
    keys: list[str],
    partition_by: list[str],
    sort_by: list[str],
    max_files: int | None,
) -> None:
    if not path_exists(spark, bronze):
        return
    states = f"{path}__states"

    def absorb(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        own = hour_states(trade_ticks(batch)).withColumn("state_day", F.to_date("price_hour"))
        own.write.mode("overwrite").partitionBy("state_day").parquet(f"{states}/batch={batch_id}")
        fresh = session.read.schema(own.schema).parquet(f"{states}/batch={batch_id}")
        days = touched_rows(session.read.schema(own.schema).parquet(states), fresh, ["state_day"])
        recover(session, path, partition_by, sort_by)
        if days is None:
            return
        touched = fresh.select(F.col("coin_id").alias("_coin"), F.col("state_day").alias("_day")).distinct()
        same = F.col("coin_id").eqNullSafe(F.col("_coin")) & F.col("state_day").eqNullSafe(F.col("_day"))
        upsert(session, path, build(merged_states(days.join(touched, same, "left_semi"))), keys, partition_by, sort_by)

    stream = spark.readStream.schema(TRADE_COLUMNS)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    writer = stream.parquet(bronze).writeStream.foreachBatch(absorb).option("checkpointLocation", f"{path}__progress")
    writer.trigger(availableNow=True).start().awaitTermination()


def load_hourly(spark: SparkSession, path: str, bronze: str, max_files: int | None = None) -> None:
    """Hourly prices of the (asset, day) groups that trades of unread files fall into."""

    def build(states: DataFrame) -> DataFrame:
        return hourly_of_states(states).withColumn("price_day", F.to_date("price_hour"))

    _load(spark, path, bronze, build, ["coin_id", "price_hour"], ["price_day"], ["coin_id", "price_hour"], max_files)


def load_ohlc(spark: SparkSession, path: str, bronze: str, max_files: int | None = None) -> None:
    """1h, 4h and 1d bars of the (asset, day) groups that trades of unread files fall into."""

    def build(states: DataFrame) -> DataFrame:
        return ohlc_of_states(states).withColumn("bucket_day", F.to_date("bucket_start"))

    keys, parts = ["coin_id", "bucket_start", "timeframe"], ["timeframe", "bucket_day"]
    _load(spark, path, bronze, build, keys, parts, ["coin_id", "bucket_start"], max_files)
