"""Generic operators against plain Python."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import bars, latest, match, merge, recurrence, series
from marketloom.session import scratch_path

T0 = dt.datetime(2024, 1, 1)


def test_latest_fixed_groups_by_key_and_not_by_row(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(400), rng.choice([1.0, 2.0, float("nan"), None]), i) for i in range(3000)]
    rows += [("late", 900, t, i) for i, t in enumerate([None, 1.0, 3.0, 3.0])] + [("none", 1, None, 5), ("unset", None, 4.0, 6)]
    df = spark.createDataFrame(rows, "k string, at long, tie double, v long").repartition(5)
    out = latest.dedup_latest_fixed(df, ["k"], F.col("at"), "tie", ["v"])
    # What is aggregated at the end are rows at the top of their key.
    kept = [r for r in rows if r[1] == max((x[1] for x in rows if x[0] == r[0] and x[1] is not None), default=None)]
    read = [f for f in out.inputFiles() if "/latest-" in f]
    assert read and spark.read.parquet(*read).count() == len(kept) < 40
    got = {r.k: r for r in out.collect()}
    assert set(got) == {"a", "b", None, "late", "none", "unset"}
    rank = lambda t: -1.0 if t is None else np.inf if t != t else t
    for k in ("a", "b", None, "late", "none"):
        ties = [r for r in kept if r[0] == k]
        top = max(rank(r[2]) for r in ties)
        assert rank(got[k].tie) == top and got[k].v in {r[3] for r in ties if rank(r[2]) == top} and got[k]._order == ties[0][1]
    assert tuple(got["unset"]) == ("unset", None, None, None)


def walk(spark, n, seed=1, keys=("a", "b"), gap_minutes=7):
    """Irregular series per key as (k, ts, x)."""
    rng = random.Random(seed)
    data = []
    for k in keys:
        at, x = T0, 100.0
        for _ in range(n):
            at += dt.timedelta(seconds=rng.randint(1, gap_minutes * 120))
            x = max(1.0, x + rng.uniform(-3, 3))
            data.append((k, at, round(x, 2)))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, ts timestamp, x double")


def by_series(df, *cols):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["k"], r["ts"])):
        out.setdefault(r["k"], []).append(tuple(r[c] for c in cols))
    return out


def test_dedup_latest_and_newest_n(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "n"), ("b", 2, "m")], "k string, t int, v string"
    )
    kept = latest.dedup_latest(df, ["k"], [F.col("t"), F.col("v")])
    assert rows(kept) == [("a", 3, "z"), ("b", 2, "m")]
    two = latest.newest_per_key(df, ["k"], [F.desc("t"), F.desc("v")], 2)
    assert rows(two) == [("a", 3, "y"), ("a", 3, "z"), ("b", 2, "m"), ("b", None, "n")]
    assert [r.t for r in latest.newest_then_ascending(df.filter("t is not null"), "t", 2).collect()] == [3, 3]


def test_positions_count_through_each_series(spark):
    df = series.with_position(walk(spark, 300), ["k"], "ts", totals={"mean": "x"})
    got = by_series(df, "_pos", "_len", "mean", "x")
    for part in got.values():
        assert [p[0] for p in part] == list(range(300))
        assert {p[1] for p in part} == {300}
        assert part[0][2] == pytest.approx(np.mean([p[3] for p in part]))


@pytest.mark.parametrize("chunk", [30, 64, 1000])
def test_chunked_rolling_equals_plain(spark, chunk):
    measures = {
        "m": ("avg", "x", 30), "s": ("stddev", "x", 7), "p": ("lag", "x", 5), "hi": ("max", "x", 3),
    }
    df = walk(spark, 250)
    plain = by_series(series.rolling(df, ["k"], "ts", measures), "m", "s", "p", "hi")
    cut = by_series(series.rolling(df, ["k"], "ts", measures, chunk_rows=chunk), "m", "s", "p", "hi")
    for k in plain:
        for a, b in zip(plain[k], cut[k], strict=True):
            assert a[2:] == b[2:]
            assert a[0] == pytest.approx(b[0], abs=1e-9)
            assert (a[1] is None and b[1] is None) or a[1] == pytest.approx(b[1], abs=1e-9)


def test_halo_longer_than_chunk_is_refused(spark):
    with pytest.raises(ValueError):
        series.with_chunks(series.with_position(walk(spark, 10), ["k"], "ts"), 4, before=5)


def sequential(xs, a, first):
    out = [first(xs[0])]
    for x in xs[1:]:
        out.append(a * out[-1] + (1 - a) * x)
    return out


@pytest.mark.parametrize("chunk", [16, 50, 400])
@pytest.mark.parametrize("span", [3, 26, 200])
def test_recurrence_with_carries(spark, chunk, span):
    placed = series.with_chunks(series.with_position(walk(spark, 333), ["k"], "ts"), chunk).drop("_halo")
    solved = recurrence.linear_recurrence(placed, ["k"], {"y": recurrence.ema_input(F.col("x"), span)}, chunk)
    for part in by_series(solved, "x", "y").values():
        want = sequential([p[0] for p in part], 1 - 2 / (span + 1), lambda x: x)
        assert [p[1] for p in part] == pytest.approx(want, rel=1e-11)


def test_recurrence_over_halo(spark):
    halo = recurrence.halo_rows(1 - 2 / 13)
    placed = series.with_position(walk(spark, 1500), ["k"], "ts")
    df = series.with_chunks(placed, 400, before=halo)
    outputs = {"y": recurrence.ema_input(F.col("x"), 12), "w": recurrence.wilder_input(F.col("x"), 5)}
    cols = recurrence.recurrence_over_halo(outputs, ["k"], 400, halo)
    solved = series.without_halo(df.withColumns(cols))
    for part in by_series(solved, "x", "y", "w").values():
        xs = [p[0] for p in part]
        assert [p[1] for p in part] == pytest.approx(sequential(xs, 1 - 2 / 13, lambda x: x), rel=1e-11)
        w = np.mean(xs[1:6])
        for i in range(6, len(xs)):
            w = (w * 4 + xs[i]) / 5
            assert part[i][2] == pytest.approx(w, rel=1e-11)


def test_recurrence_refuses_overflow_and_short_halo(spark):
    placed = series.with_chunks(series.with_position(walk(spark, 5), ["k"], "ts"), 5000).drop("_halo")
    with pytest.raises(ValueError):
        recurrence.linear_recurrence(placed, ["k"], {"y": (F.col("x"), 0.5)}, 5000)
    with pytest.raises(ValueError):
        recurrence.recurrence_over_halo({"y": (F.col("x"), 0.99)}, ["k"], 100, 10)


def test_first_in_range_against_brute_force(spark):
    rng = random.Random(3)
    left = [("a", T0 + dt.timedelta(seconds=rng.randint(0, 4000)), i) for i in range(60)]
    times = sorted(rng.sample(range(0, 4500), 90))
    right = [("a", T0 + dt.timedelta(seconds=t), float(t)) for t in times] + [("b", T0, 1.0)]
    got = match.first_in_range(
        spark.createDataFrame(left, "k string, ts timestamp, id int"),
        spark.createDataFrame(right, "k string, rts timestamp, v double"),
        ["k"], "ts", "rts", 60, 300, ["id"], ["v"],
    )
    want = {}
    for _, ts, i in left:
        hits = [v for k, r, v in right if k == "a" and 60 <= (r - ts).total_seconds() <= 300]
        want[i] = min(hits) if hits else None
    assert {r.id: r.matched_v for r in got.collect()} == want


def test_orphans_count_null_keys(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(match.orphans(child, parent, "c", "p")) == [(2,), (None,)]


def test_upsert_updates_inserts_and_is_idempotent(spark, rows):
    path = scratch_path(spark, "t")
    schema = "k int, part string, v string"
    base = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "y", "c"), (4, "z", "d")], schema)
    merge.upsert(spark, path, base, ["k"], ["part"], ["k"])
    change = spark.createDataFrame([(2, "x", "B"), (5, "w", "e")], schema)
    before = {r[0] for r in spark.read.parquet(path).filter("part = 'z'").select(F.input_file_name()).collect()}
    for _ in range(2):
        merge.upsert(spark, path, change, ["k"], ["part"], ["k"])
        assert rows(spark.read.parquet(path), "k", "part", "v") == [
            (1, "x", "a"), (2, "x", "B"), (3, "y", "c"), (4, "z", "d"), (5, "w", "e"),
        ]
    after = {r[0] for r in spark.read.parquet(path).filter("part = 'z'").select(F.input_file_name()).collect()}
    assert before == after, "an untouched partition must not be rewritten"
    merge.upsert(spark, path, change.filter("k < 0"), ["k"], ["part"], ["k"])
    assert spark.read.parquet(path).count() == 5


@pytest.mark.parametrize("count", [4, 600])
def test_upsert_prunes_and_keeps_the_null_partition(spark, count):
    path = scratch_path(spark, "t")
    base = spark.range(2 * count).select(
        F.col("id").alias("k"), F.when(F.col("id") % count > 0, F.col("id") % count).alias("part"), F.lit("a").alias("v")
    )
    merge.upsert(spark, path, base, ["k"], ["part"])
    changes = base.filter(f"k < {count} AND coalesce(part, 0) <> 2").withColumn("v", F.lit("b"))
    merge.upsert(spark, path, changes, ["k"], ["part"])
    table = spark.read.parquet(path)
    assert table.count() == 2 * count and table.filter("v = 'b'").count() == count - 1
    assert table.filter("part IS NULL").count() == 2
    touched = merge.touched_rows(table, changes, ["part"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "Join" not in plan


def test_upsert_with_two_partition_columns(spark, rows):
    path = scratch_path(spark, "t")
    schema = "k int, p string, q int, v string"
    merge.upsert(spark, path, spark.createDataFrame([(1, "x", 1, "a"), (2, "x", 2, "a"), (3, None, 1, "a")], schema), ["k"], ["p", "q"])
    merge.upsert(spark, path, spark.createDataFrame([(4, None, 1, "b"), (1, "x", 1, "b")], schema), ["k"], ["p", "q"])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "b"), (2, "a"), (3, "a"), (4, "b")]


def test_create_if_missing(spark):
    from marketloom.schemas import SILVER_PRICES

    path = scratch_path(spark, "empty")
    assert merge.create_if_missing(spark, path, SILVER_PRICES, ["coin_id"])
    assert not merge.create_if_missing(spark, path, SILVER_PRICES, ["coin_id"])
    assert spark.read.schema(SILVER_PRICES).parquet(path).count() == 0


def test_compaction_rewrites_crowded_partitions_only(spark, rows):
    path = scratch_path(spark, "t")
    for i in range(6):
        spark.createDataFrame([(i, "busy")], "k int, part string").coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    spark.createDataFrame([(9, "calm")], "k int, part string").coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    before = merge.compact(spark, path, ["part"], ["k"])
    assert rows(before) == [("busy", 6), ("calm", 1)]
    table = spark.read.parquet(path)
    named = table.withColumn("f", F.input_file_name())
    files = named.groupBy("part").agg(F.count_distinct("f").alias("n"))
    assert {(r.part, r.n) for r in files.collect()} == {("busy", 1), ("calm", 1)}
    assert sorted(r.k for r in table.collect()) == [0, 1, 2, 3, 4, 5, 9]


def test_wide_bars_from_hourly_equal_bars_from_trades(spark, sf):
    from marketloom.sources import stand_ins

    ticks = stand_ins.ticks(spark, sf)
    hours = bars.ohlc_1h(ticks)
    rebuilt = bars.reaggregate(hours, "4 hours")
    every = bars.market_ohlc(ticks).filter("timeframe = '4h'").drop("timeframe")
    cols = rebuilt.columns
    assert rebuilt.exceptAll(every.select(cols)).count() == 0
    assert every.select(cols).exceptAll(rebuilt).count() == 0


def test_bar_without_volume_has_no_vwap(spark):
    data = [("a", 0, 10.0, 0.0), ("a", 1000, 12.0, 0.0), ("b", 0, 5.0, 2.0)]
    df = spark.createDataFrame(data, "coin_id string, trade_time_ms long, price_usd double, quantity double")
    got = {r.coin_id: r for r in bars.vwap_bars(bars.trade_ticks(df)).collect()}
    assert got["a"].vwap is None and got["a"].is_anomaly == 0 and (got["a"].open, got["a"].close) == (10.0, 12.0)
    assert got["b"].vwap == 5.0 and got["b"].stddev_price is None and got["b"].z_score is None


def test_equal_times_open_deterministically(spark):
    data = [("a", 5, float(p), 1.0) for p in range(20)]
    schema = "coin_id string, trade_time_ms long, price_usd double, quantity double"
    opens = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, schema).repartition(seed + 1)
        opens.add(bars.vwap_bars(bars.trade_ticks(df)).first().open)
    assert len(opens) == 1
