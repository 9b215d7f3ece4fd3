"""Streams must agree with their batch twins."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.operators.bars import trade_ticks, vwap_bars
from marketloom.queries.streams import drain
from marketloom.session import scratch_path
from marketloom.streaming import jobs

SCHEMA = "coin_id string, trade_time_ms long, price_usd double, quantity double"
CUT = ["vwap", "avg_price", "stddev_price", "z_score"]


def trades(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def compare(left, right):
    columns = [F.round(c, 9).alias(c) if c in CUT else F.col(c) for c in right.columns]
    left, right = left.select(columns), right.select(columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def feed(spark, path, *batches):
    """One file per micro-batch, in order."""
    for data in batches:
        trades(spark, data).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return jobs.file_source(spark, path, trades(spark, []).schema, maxFilesPerTrigger="1")


FIRST = [("a", 1000 * i, 10.0 + i % 7, float(i % 3)) for i in range(100)] + [("b", 500, 1.0, 1.0)]
SECOND = [("a", 100_000 + 1000 * i, 20.0 + i % 5, 1.0) for i in range(200)]
SENTINEL = [("z", 10_000_000, 1.0, 1.0)]


def test_append_with_sentinel_equals_batch(spark):
    source, table, marks = (scratch_path(spark, n) for n in ("in", "out", "marks"))
    feed(spark, source, FIRST, SECOND, SENTINEL)
    bars = jobs.stream_bars(stream(spark, source))
    drain(spark, lambda: jobs.append_sink(bars, table, marks, ["coin_id"], available_now=True))
    batch = vwap_bars(trade_ticks(trades(spark, FIRST + SECOND)))
    compare(spark.read.parquet(table).select(batch.columns), batch)


def test_rows_behind_the_watermark_are_dropped(spark):
    source, table, marks = (scratch_path(spark, n) for n in ("in", "out", "marks"))
    late = [("a", 2000, 999.0, 1.0)]
    feed(spark, source, FIRST, SECOND, late, SENTINEL)
    bars = jobs.stream_bars(stream(spark, source))
    drain(spark, lambda: jobs.append_sink(bars, table, marks, ["coin_id"], available_now=True))
    assert spark.read.parquet(table).agg(F.max("high")).first()[0] < 999.0


def test_upserting_job_keeps_open_bars_and_restarts(spark):
    source, table, marks = (scratch_path(spark, n) for n in ("in", "out", "marks"))
    feed(spark, source, FIRST)
    start = lambda: jobs.upsert_sink(jobs.stream_bars(stream(spark, source)), table, marks, available_now=True)
    drain(spark, start)
    compare(spark.read.parquet(table).drop("bar_day"), vwap_bars(trade_ticks(trades(spark, FIRST))))
    feed(spark, source, SECOND)
    drain(spark, start)
    compare(spark.read.parquet(table).drop("bar_day"), vwap_bars(trade_ticks(trades(spark, FIRST + SECOND))))


def test_stream_match_evaluates_each_prediction_once(spark):
    t = dt.datetime(2024, 1, 1)
    at = lambda s: t + dt.timedelta(seconds=s)
    preds, bars, out, marks = (scratch_path(spark, n) for n in ("p", "b", "o", "m"))
    p = spark.createDataFrame(
        [("m", "a", at(0), 11.0, 10.0), ("m", "a", at(400), 9.0, 10.0)],
        "model string, coin_id string, ts timestamp, predicted_price double, current_price double",
    )
    b = spark.createDataFrame(
        [("a", at(30), 1.0), ("a", at(60), 2.0), ("a", at(90), 3.0), ("a", at(701), 4.0), ("b", at(500), 5.0)],
        "coin_id string, window_start timestamp, close double",
    )
    p.write.parquet(preds)
    b.write.parquet(bars)
    pairs = jobs.match_stream(jobs.file_source(spark, preds, p.schema), jobs.file_source(spark, bars, b.schema))
    drain(spark, lambda: jobs.append_sink(pairs, out, marks, available_now=True))
    rows = jobs.first_match(spark.read.parquet(out)).collect()
    assert [(r.ts, r.matched_ts, r.matched_close) for r in rows] == [(at(0), at(60), 2.0)]


def test_running_accuracy_counts_each_prediction_once_and_forgets(spark):
    t = dt.datetime(2024, 1, 1)
    at = lambda s: t + dt.timedelta(seconds=s)
    preds, bars, out, marks = (scratch_path(spark, n) for n in ("p", "b", "o", "m"))
    pred_schema = "model string, coin_id string, ts timestamp, predicted_price double, current_price double"
    bar_schema = "coin_id string, window_start timestamp, close double"
    one, two, other = ("m", "a", at(0), 11.0, 10.0), ("m", "a", at(400), 9.0, 10.0), ("n", "a", at(0), 9.0, 10.0)
    batches = [
        ([one, other], [("a", at(150), 20.0), ("a", at(30), 1.0)]),
        ([one], [("a", at(90), 12.0), ("b", at(61), 99.0)]),  # told again; an earlier bar arrives later
        ([two], [("a", at(460), 8.0)]),
        ([one, two], [("a", at(700), 7.0), ("a", at(701), 5.0)]),
        ([("", "", at(9000), 0.0, 0.0)], [("", at(9000), 0.0)]),
    ]
    totals = []
    for p, b in batches:
        spark.createDataFrame(p, pred_schema).coalesce(1).write.mode("append").parquet(preds)
        spark.createDataFrame(b, bar_schema).coalesce(1).write.mode("append").parquet(bars)
        streams = jobs.file_source(spark, preds, spark.createDataFrame(p, pred_schema).schema), jobs.file_source(spark, bars, spark.createDataFrame(b, bar_schema).schema)
        job = jobs.accuracy_sink(jobs.evaluate_stream(*streams), out, marks, available_now=True)
        job.awaitTermination()
        totals.append(sum(r.total_evaluated for r in jobs.running_accuracy(spark, out).collect()))
    # The rows that end the streams are all that is left of the three operators' state.
    assert all(s["numRowsTotal"] <= 3 for s in job.lastProgress["stateOperators"])
    assert totals[0] == 0 and totals == sorted(totals)
    got = {r.model: (r.total_evaluated, r.mae, r.direction_accuracy, r.correct_direction) for r in jobs.running_accuracy(spark, out).collect()}
    assert got == {"m": (2, 1.0, 100.0, 2), "n": (1, 3.0, 0.0, 0)}


def _bars(spark, rows):
    made = spark.createDataFrame(rows, "coin_id string, second long, close double")
    return made.select("coin_id", F.timestamp_seconds("second").alias("window_start"), "close", F.lit(1.0).alias("total_volume"))


def test_rows_before_new_bars_come_from_the_tail(spark):
    tail = _bars(spark, [("a", s, float(s)) for s in range(10, 50, 10)] + [("b", 10, 1.0)])
    past = _bars(spark, [(c, s, float(s)) for c in "abc" for s in range(1, 50)])

    def seconds(new, read=lambda: past):
        rows = jobs.bars_before(_bars(spark, new), tail, read, 2)
        return sorted((r.coin_id, r.window_start.timestamp()) for r in rows.collect())

    def never():
        raise AssertionError("the history was read")

    in_tail = [("a", float(s)) for s in range(10, 50, 10)]
    assert seconds([("a", 60, 1.0)], never) == in_tail
    assert seconds([("a", 35, 1.0), ("b", 20, 1.0)], never) == in_tail + [("b", 10.0)]  # late, and a short tail that is whole
    assert seconds([("a", 40, 9.0)], never) == in_tail[:3]  # a bar that comes again replaces its copy
    late = [("a", float(s)) for s in (11, 12, 13, 14)]
    assert seconds([("a", 15, 1.0)]) == sorted(late + in_tail)
    assert seconds([("c", 4, 1.0)]) == [("c", 1.0), ("c", 2.0), ("c", 3.0)]
    assert seconds([]) == []


def test_scores_carry_a_bounded_tail(spark, tmp_path):
    history, out = str(tmp_path / "bars"), str(tmp_path / "scores")
    files = [[("a", s, float(s)) for s in range(i * 5, i * 5 + 5) if s != 7] for i in range(3)] + [[("a", 7, 7.0), ("b", 1, 1.0)]]

    def score(window, new):
        w = Window.partitionBy("coin_id").orderBy("window_start").rowsBetween(-3, 0)
        return window.withColumn("total", F.sum("close").over(w)).join(new, ["coin_id", "window_start"], "left_semi")

    for part in files:
        _bars(spark, part).coalesce(1).write.mode("append").parquet(history)
        bars = jobs.file_source(spark, history, spark.read.parquet(history).schema)
        jobs.score_sink(bars, history, out, str(tmp_path / "marks"), score, 3, available_now=True).awaitTermination()
    got = {(r.coin_id, r.window_start.timestamp()): r.total for r in spark.read.parquet(out).collect()}
    seen = [s for s in range(15) if s != 7]
    wanted = {("a", float(s)): float(sum(seen[max(0, i - 3) : i + 1])) for i, s in enumerate(seen)}
    assert got == wanted | {("a", 7.0): 4.0 + 5 + 6 + 7, ("b", 1.0): 1.0}
    tails = sorted(p.name for p in (tmp_path / "scores__tail").iterdir())
    assert tails == ["batch=2", "batch=3"] and spark.read.parquet(f"{out}__tail/batch=3").count() == 7
