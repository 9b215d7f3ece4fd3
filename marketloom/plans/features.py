"""Twenty technical features per bar, training samples and sequences.

All windows run over (series, chunk) groups of a few hundred rows, see ``operators.series``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numbers import clip, relative_return, sentiment_norm, zero_if_missing
from marketloom.functions.times import hour_cycle
from marketloom.operators.recurrence import (
    ema_input,
    ema_of_difference,
    halo_rows,
    linear_recurrence,
    recurrence_over_halo,
    wilder_input,
)
from marketloom.operators.series import (
    CHUNK,
    LENGTH,
    POS,
    chunk_window,
    with_chunks,
    with_position,
    without_halo,
)
from marketloom.session import staged

# The feature order.
FEATURES = [
    "return_1",
    "return_3",
    "return_5",
    "return_10",
    "volatility_5",
    "volatility_10",
    "volatility_20",
    "rsi_7",
    "rsi_14",
    "macd",
    "macd_signal",
    "macd_hist",
    "bb_position",
    "volume_ratio_5",
    "volume_ratio_10",
    "momentum_5",
    "momentum_10",
    "fear_greed_norm",
    "hour_sin",
    "hour_cos",
]
# Indicator periods.
RETURN_LAGS = [1, 3, 5, 10]
VOLATILITY_ROWS = [5, 10, 20]
RSI_PERIODS = [7, 14]
MACD_SPANS = (12, 26, 9)
BOLLINGER_ROWS, BOLLINGER_WIDTH = 20, 2.0
VOLUME_ROWS = [5, 10]
MOMENTUM_LAGS = [5, 10]

CHUNK_ROWS = 2048
# Rows of the previous chunk: the slowest smoothing needs them to forget its start, and they
# cover the longest nested frame (20 rows of one-row returns) many times over.
REACH = max(halo_rows((max(RSI_PERIODS) - 1) / max(RSI_PERIODS)), halo_rows(1 - 2 / (MACD_SPANS[1] + 1)))
SCAN_ROWS = 512
# Bars from which a series gives a sample: look-back, horizon and one row.
SAMPLE_ROWS = 34
NEUTRAL = 50


class _Frames:
    """Column builders over one chunked series; ``warm`` fills the rows before the first full frame."""

    def __init__(self, keys: list[str], warmup: str):
        self.ordered = chunk_window(keys)
        self.whole = Window.partitionBy(*keys, CHUNK)
        self.warmup = warmup

    def trailing(self, n: int):
        return self.ordered.rowsBetween(-(n - 1), 0)

    def lag(self, col: str, k: int) -> Column:
        return F.lag(col, k).over(self.ordered)

    def warm(self, value: str, first_row: int, fallback: float | Column | None = None, positive: bool = False) -> Column:
        """``value`` from ``first_row`` on; earlier rows take the value of ``first_row``.

        Those rows are all in chunk 0, so the fill looks at one chunk only. With
        warmup='null' they stay NULL, which keeps the feature causal.
        """
        col = F.col(value)
        if self.warmup == "null":
            return F.when(F.col(POS) >= first_row, col)
        first = F.max(F.when(F.col(POS) == first_row, col)).over(self.whole)
        if positive:
            first = F.when(first > 0, first)
        if fallback is not None:
            first = F.coalesce(first, fallback if isinstance(fallback, Column) else F.lit(fallback))
        return F.when(F.col(POS) < first_row, first).otherwise(col)


def positions(
    bars: DataFrame,
    keys: list[str],
    ts: str,
    price: str,
    volume: str,
    stage: bool = False,
) -> DataFrame:
    """Positioned series of any length with their mean price.

    With ``stage`` the result is written to the shared working folder and read back, for callers
    that pass over it several times.
    """
    base = bars.select(
        *keys, F.col(ts).alias("ts"), F.col(price).alias("price"), F.coalesce(volume, F.lit(0.0)).alias("volume")
    ).filter(F.col("price").isNotNull())
    placed = with_position(base, keys, "ts", totals={"_mean_price": "price"})
    return staged(placed, "positions") if stage else placed


def short_series(bars: DataFrame, keys: list[str], min_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Series that have features but are too short for a training sample, with their row counts."""
    return bars.groupBy(*keys).agg(F.count(F.lit(1)).alias("bars")).filter(F.col("bars") < min_rows)


def window_features(
    placed: DataFrame,
    keys: list[str],
    warmup: str = "backfill",
    horizon: int = 3,
    macd_scale: str = "series",
) -> DataFrame:
    """All features of a positioned series, the forward price and the trend inputs.

    One exchange and one sort by (series, chunk): bounded frames, warm-up fills and the
    recurrences of RSI and MACD read the same rows. ``macd_scale`` 'series' divides by the mean
    price of the whole series (which looks ahead), 'price' by the row's own price.
    """
    f = _Frames(keys, warmup)
    df = with_chunks(placed, CHUNK_ROWS, before=REACH, after=horizon)
    price, volume, pos = F.col("price"), F.col("volume"), F.col(POS)

    def returns(k: int) -> Column:
        raw = clip(relative_return(price, f.lag("price", k)), -0.5, 0.5)
        return F.when(pos >= k, raw).otherwise(F.lit(0.0))

    delta = price - f.lag("price", 1)
    df = df.withColumns(
        {
            **{f"return_{k}": returns(k) for k in RETURN_LAGS},
            **{f"_mom_{k}": relative_return(price, f.lag("price", k)) for k in MOMENTUM_LAGS},
            "_gain": F.greatest(delta, F.lit(0.0)),
            "_loss": F.greatest(-delta, F.lit(0.0)),
            "_bb_mid": F.avg("price").over(f.trailing(BOLLINGER_ROWS)),
            "_bb_std": F.stddev_pop("price").over(f.trailing(BOLLINGER_ROWS)),
            **{f"_vavg_{w}": F.avg("volume").over(f.ordered.rowsBetween(-w, -1)) for w in VOLUME_ROWS},
            "future_price": F.lead("price", horizon).over(f.ordered),
            "_sma_5": F.avg("price").over(f.trailing(5)),
            "_sma_10": F.avg("price").over(f.trailing(10)),
        }
    )
    half = F.lit(BOLLINGER_WIDTH) * F.col("_bb_std")
    bb = clip((price - (F.col("_bb_mid") - half)) / (half * 2 + F.lit(1e-10)), 0.0, 1.0)

    def mean_return(k: int) -> Column:
        return F.when(pos + 1 >= k, F.avg("return_1").over(f.trailing(k))).otherwise(F.lit(0.0))

    df = df.withColumns(
        {
            **{f"_vol_{w}": F.stddev_pop("return_1").over(f.trailing(w)) for w in VOLATILITY_ROWS},
            "_bb": F.when(F.col("_bb_std") > 0, bb).otherwise(F.lit(0.5)),
            **{
                f"_vr_{w}": F.when(F.col(f"_vavg_{w}") > 0, volume / F.col(f"_vavg_{w}")).otherwise(F.lit(1.0))
                for w in VOLUME_ROWS
            },
            "trend_momentum": F.lit(0.5) * mean_return(3) + F.lit(0.3) * mean_return(5) + F.lit(0.2) * mean_return(10),
        }
    )
    fast, slow, span = MACD_SPANS
    rest, a_fast, a_slow = ema_of_difference(price, fast, slow, span)
    smooth = {"ema_fast": ema_input(price, fast), "ema_slow": ema_input(price, slow), "_rest": rest}
    for n in RSI_PERIODS:
        smooth[f"_up_{n}"] = wilder_input(F.col("_gain"), n)
        smooth[f"_down_{n}"] = wilder_input(F.col("_loss"), n)
    df = df.withColumns(
        {
            **recurrence_over_halo(smooth, keys, CHUNK_ROWS, REACH, horizon),
            **{f"volatility_{w}": f.warm(f"_vol_{w}", w, 0.0, positive=True) for w in VOLATILITY_ROWS},
            "recent_vol": F.when(pos + 1 >= 10, F.col("_vol_10")).otherwise(F.lit(0.001)),
            # A series that ends before its first full frame takes the neutral value.
            "bb_position": f.warm("_bb", BOLLINGER_ROWS, 0.5),
            **{f"volume_ratio_{w}": clip(f.warm(f"_vr_{w}", w, 1.0), 0.0, 5.0) / 5.0 for w in VOLUME_ROWS},
            **{f"momentum_{k}": clip(f.warm(f"_mom_{k}", k, 0.0), -0.5, 0.5) for k in MOMENTUM_LAGS},
            "sma_5": f.warm("_sma_5", 4, price),
            "sma_10": f.warm("_sma_10", 9, price),
        }
    )
    line = F.col("ema_fast") - F.col("ema_slow")
    signal = F.lit(a_fast) * F.col("ema_fast") - F.lit(a_slow) * F.col("ema_slow") + F.col("_rest")
    mean = F.col("_mean_price") if macd_scale == "series" else price
    scale = F.when(mean > 0, mean).otherwise(F.lit(1.0))

    def rsi(n: int) -> Column:
        strength = F.col(f"_up_{n}") / (F.col(f"_down_{n}") + F.lit(1e-10))
        return F.when(pos > n, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength))

    return without_halo(df).withColumns(
        {
            "macd": clip(line / scale, -0.1, 0.1),
            "macd_signal": clip(signal / scale, -0.1, 0.1),
            "macd_hist": clip((line - signal) / scale, -0.1, 0.1),
            **{f"rsi_raw_{n}": rsi(n) for n in RSI_PERIODS},
            **{f"rsi_{n}": F.coalesce(rsi(n), F.lit(50.0)) / 100.0 for n in RSI_PERIODS},
        }
    )


def build_features(
    bars: DataFrame,
    sentiment: DataFrame | None = None,
    keys: list[str] | None = None,
    ts: str = "window_start",
    price: str = "close",
    volume: str = "total_volume",
    macd_scale: str = "series",
    warmup: str = "backfill",
    horizon: int = 3,
    stage: bool = False,
) -> DataFrame:
    """The feature matrix as columns, with price, position, forward price and trend inputs.

    Sentiment is the silver daily index, joined on the bar's date; days without a reading count
    as neutral.
    """
    keys = keys or ["coin_id"]
    placed = positions(bars, keys, ts, price, volume, stage)
    df = window_features(placed, keys, warmup, horizon, macd_scale)
    if sentiment is None:
        df = df.withColumn("fear_greed_norm", F.lit(0.0))
    else:
        daily = sentiment.select(F.col("index_date").alias("_day"), "fear_greed_value")
        value = F.coalesce("fear_greed_value", F.lit(NEUTRAL))
        df = df.withColumn("_day", F.to_date("ts")).join(daily, "_day", "left")
        df = df.withColumn("fear_greed_norm", sentiment_norm(value))
    sin, cos = hour_cycle(F.col("ts"))
    df = df.withColumns({"hour_sin": sin, "hour_cos": cos})
    # Every feature is clipped or bounded, so only missing values are left to replace. Twenty of
    # these end up in one generated method; the longer general form would keep it from being
    # compiled by the JVM.
    wrap = zero_if_missing if warmup == "backfill" else (lambda c: c)
    return df.select(
        *keys,
        "ts",
        "price",
        "volume",
        POS,
        LENGTH,
        "future_price",
        "trend_momentum",
        "recent_vol",
        "sma_5",
        "sma_10",
        *[F.col(f"rsi_raw_{n}") for n in RSI_PERIODS],
        *[wrap(F.col(name)).alias(name) for name in FEATURES],
    )


def training_samples(features: DataFrame, lookback: int = 30, horizon: int = 3) -> DataFrame:
    """Rows lookback..n-horizon-1 of every series with direction label and forward return."""
    first = max(lookback, 1)
    usable = (F.col(POS) >= first) & (F.col(POS) < F.col(LENGTH) - horizon)
    forward = relative_return(F.col("future_price"), F.col("price"))
    rows = features.filter(usable).withColumn("forward_return", forward)
    return rows.withColumn("label", (F.col("forward_return") > 0).cast("double"))


def with_sequences(
    features: DataFrame, keys: list[str] | None = None, steps: int = 10, include_current: bool = False
) -> DataFrame:
    """Add the previous ``steps`` feature rows as one flat array; rows without enough history are dropped."""
    keys = keys or ["coin_id"]
    last = 0 if include_current else -1
    placed = with_chunks(features, SCAN_ROWS, before=steps)
    frame = chunk_window(keys).rowsBetween(last - steps + 1, last)
    rows = placed.withColumn("_row", F.array(*FEATURES))
    rows = rows.withColumn("sequence", F.flatten(F.collect_list("_row").over(frame))).drop("_row")
    needed = F.col(POS) >= (steps - 1 if include_current else steps)
    return without_halo(rows).filter(needed).drop(CHUNK)


def min_max_scaled(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Min-max normalised columns.

    The extremes, one row per series, are staged: the planner then knows their size and need not
    shuffle the rows by their few series to join them.
    """
    ranges = df.groupBy(*keys).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )
    joined = df.join(staged(ranges, "ranges"), keys)
    scaled = {}
    for c in columns:
        span = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        scaled[f"{c}_norm"] = (F.col(c) - F.col(f"_lo_{c}")) / F.when(span > 0, span).otherwise(F.lit(1.0))
    return joined.withColumns(scaled).drop(*[f"_lo_{c}" for c in columns], *[f"_hi_{c}" for c in columns])


def sma_cross(short: Column, long: Column) -> Column:
    """Ten times the relative distance of two means, clipped to -1..1."""
    return clip((short - long) / (long + F.lit(1e-10)) * 10, -1.0, 1.0)


def technical_vote(rsi: Column, sma_short: Column, sma_long: Column) -> Column:
    """0.6 of the RSI distance from neutral plus 0.4 of the mean crossing, clipped."""
    rsi_part = clip((F.lit(50.0) - F.coalesce(rsi, F.lit(50.0))) / 50.0, -1.0, 1.0)
    return clip(F.lit(0.6) * rsi_part + F.lit(0.4) * sma_cross(sma_short, sma_long), -1.0, 1.0)


def sentiment_vote(value: Column) -> Column:
    return sentiment_norm(value)


def smoothed(df: DataFrame, keys: list[str], ts: str, column: str, span: int, out: str) -> DataFrame:
    """Exponential mean of one column along each series."""
    placed = with_chunks(with_position(df, keys, ts), SCAN_ROWS).drop("_halo")
    return linear_recurrence(placed, keys, {out: ema_input(F.col(column), span)}, SCAN_ROWS).drop(
        POS, CHUNK, LENGTH
    )
