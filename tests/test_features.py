"""Features against a row-by-row computation."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators.series import POS
from marketloom.plans import features as feat

T0 = dt.datetime(2024, 1, 1)


def make_bars(spark, n=900, seed=5):
    rng = random.Random(seed)
    data, series = [], {}
    for k in ("a", "b"):
        at, p = T0, 50.0
        series[k] = []
        for _ in range(n):
            at += dt.timedelta(seconds=30 * rng.randint(1, 30))
            p = max(0.5, p * (1 + rng.uniform(-0.03, 0.03)))
            v = float(rng.randint(0, 9))
            data.append((k, at, p, v))
            series[k].append((at, p, v))
    data.append(("short", T0, 1.0, 1.0))
    df = spark.createDataFrame(data, "coin_id string, window_start timestamp, close double, total_volume double")
    return df, series


def expected(points):
    """The feature table of one series, one plain loop per rule."""
    ts, p, v = (list(c) for c in zip(*points))
    n = len(p)
    out = {name: [0.0] * n for name in feat.FEATURES}

    def rel(i, k):
        return (p[i] - p[i - k]) / (p[i - k] + 1e-10)

    def clip(x, lo, hi):
        return max(lo, min(hi, x))

    for k in (1, 3, 5, 10):
        out[f"return_{k}"] = [clip(rel(i, k), -0.5, 0.5) if i >= k else 0.0 for i in range(n)]
    r1 = out["return_1"]
    for w in (5, 10, 20):
        vol = [float(np.std(r1[i - w + 1 : i + 1])) if i >= w else 0.0 for i in range(n)]
        out[f"volatility_{w}"] = [vol[w] if i < w and vol[w] > 0 else x for i, x in enumerate(vol)]
    for period in (7, 14):
        gains = [max(p[i] - p[i - 1], 0.0) for i in range(1, n)]
        losses = [max(p[i - 1] - p[i], 0.0) for i in range(1, n)]
        g, ls = sum(gains[:period]) / period, sum(losses[:period]) / period
        out[f"rsi_{period}"] = [0.5] * n
        for i in range(period, n - 1):
            g = (g * (period - 1) + gains[i]) / period
            ls = (ls * (period - 1) + losses[i]) / period
            out[f"rsi_{period}"][i + 1] = (100 - 100 / (1 + g / (ls + 1e-10))) / 100

    def ema(xs, span):
        a, ys = 2 / (span + 1), [xs[0]]
        for x in xs[1:]:
            ys.append(a * x + (1 - a) * ys[-1])
        return ys

    line = [f - s for f, s in zip(ema(p, 12), ema(p, 26))]
    signal = ema(line, 9)
    mean = sum(p) / n
    out["macd"] = [clip(x / mean, -0.1, 0.1) for x in line]
    out["macd_signal"] = [clip(x / mean, -0.1, 0.1) for x in signal]
    out["macd_hist"] = [clip((x - y) / mean, -0.1, 0.1) for x, y in zip(line, signal)]
    bb = [0.5] * n
    for i in range(20, n):
        mid, sd = np.mean(p[i - 19 : i + 1]), np.std(p[i - 19 : i + 1])
        bb[i] = clip((p[i] - (mid - 2 * sd)) / (4 * sd + 1e-10), 0, 1)
    out["bb_position"] = [bb[20] if i < 20 else x for i, x in enumerate(bb)]
    for w in (5, 10):
        raw = [1.0] * n
        for i in range(w, n):
            avg = sum(v[i - w : i]) / w
            raw[i] = v[i] / avg if avg > 0 else 1.0
        out[f"volume_ratio_{w}"] = [clip(raw[w] if i < w else x, 0, 5) / 5 for i, x in enumerate(raw)]
    for k in (5, 10):
        out[f"momentum_{k}"] = [clip(rel(max(i, k), k), -0.5, 0.5) for i in range(n)]
    hours = [t.hour + t.minute / 60 for t in ts]
    out["hour_sin"] = [math.sin(2 * math.pi * h / 24) for h in hours]
    out["hour_cos"] = [math.cos(2 * math.pi * h / 24) for h in hours]
    return out


@pytest.fixture(scope="module")
def computed(spark):
    bars, series = make_bars(spark)
    return feat.build_features(bars).cache(), series


def test_features_match_the_rules(computed):
    df, series = computed
    rows = df.collect()
    assert {r["coin_id"] for r in rows} == {"a", "b", "short"}
    for k, points in series.items():
        got = sorted((r for r in rows if r["coin_id"] == k), key=lambda r: r[POS])
        want = expected(points)
        for name in feat.FEATURES:
            assert [r[name] for r in got] == pytest.approx(want[name], abs=1e-9), name


@pytest.mark.parametrize("chunk", [700, 760])
def test_chunk_length_does_not_matter(spark, computed, monkeypatch, chunk):
    df, _ = computed
    bars, _ = make_bars(spark)
    monkeypatch.setattr(feat, "CHUNK_ROWS", chunk)
    other = {(r.coin_id, r.ts): r for r in feat.build_features(bars).collect()}
    for r in df.collect():
        o = other[(r.coin_id, r.ts)]
        assert [r[n] for n in feat.FEATURES] == pytest.approx([o[n] for n in feat.FEATURES], abs=1e-9)
        assert r.future_price == o.future_price


def test_causal_warmup_leaves_nulls(spark):
    bars, _ = make_bars(spark, 80)
    first = feat.build_features(bars, warmup="null", macd_scale="price").filter(f"{POS} = 3 and coin_id = 'a'").first()
    assert first.bb_position is None and first.volatility_5 is None and first.macd is not None


def test_short_series_are_reported(spark):
    bars, _ = make_bars(spark, 80)
    assert [tuple(r) for r in feat.short_series(bars, ["coin_id"]).collect()] == [("short", 1)]


def test_samples_and_sequences(computed):
    df, series = computed
    n = len(series["a"])
    samples = feat.training_samples(df).filter("coin_id = 'a'").collect()
    assert sorted(r[POS] for r in samples) == list(range(30, n - 3))
    prices = [p for _, p, _ in series["a"]]
    for r in samples:
        assert r.label == float(prices[r[POS] + 3] > prices[r[POS]])
    by_pos = {r[POS]: [r[f] for f in feat.FEATURES] for r in df.filter("coin_id = 'a'").collect()}
    seqs = feat.with_sequences(df).filter("coin_id = 'a'").collect()
    assert len(seqs) == n - 10
    for r in seqs:
        want = [x for i in range(r[POS] - 10, r[POS]) for x in by_pos[i]]
        assert r.sequence == want
    now = feat.with_sequences(df, include_current=True).filter(f"coin_id = 'a' and {POS} = 9").first()
    assert now.sequence[-20:] == by_pos[9]


@pytest.mark.parametrize("warmup", ["backfill", "null"])
def test_series_of_any_length_have_features(spark, warmup):
    t = dt.datetime(2024, 1, 1)
    sizes = {"a": 1, "b": 7, "c": 15, "d": 30, "e": 59}
    data = [(c, t + dt.timedelta(seconds=30 * i), 100.0 + (i * 7) % 5, 1.0 + i % 3) for c, n in sizes.items() for i in range(n)]
    bars = spark.createDataFrame(data, "coin_id string, window_start timestamp, close double, total_volume double")
    made = feat.build_features(bars, warmup=warmup)
    counts = {r.coin_id: r.n for r in made.groupBy("coin_id").agg(F.count("*").alias("n")).collect()}
    assert counts == sizes
    if warmup == "backfill":
        assert made.filter(" OR ".join(f"{c} IS NULL" for c in feat.FEATURES)).count() == 0
        first = made.filter("coin_id = 'a'").first()
        assert (first.bb_position, first.volume_ratio_5, first.momentum_5, first.rsi_7) == (0.5, 0.2, 0.0, 0.5)
    samples = feat.training_samples(made).groupBy("coin_id").agg(F.count("*").alias("n")).collect()
    assert {r.coin_id: r.n for r in samples} == {"e": 26}
