"""Time the headline queries; prints one JSON line.

Every query runs once to compile and is then timed; the value is the median of the timed runs. The same
queries over a tenth of the rows, where that folder exists, give the growth from one size to the other.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from marketloom.queries import queries
from marketloom.session import build_session

HEADLINE = [
    "m10_fact_market_daily",
    "m1_w1_silver_daily_prices",
    "m2_w1_silver_sentiment",
    "m7_j1_p20_int_market_enriched",
    "m8_a1_p9_dim_coins",
    "m9_a7_p13_p14_p15_dim_dates",
    "m14_w11_k4_latest_signals",
    "j3_weekend_effect",
    "a16_p26_volatility_ranking",
    "s1_s2_j5_normalise_trades",
    "s8_j6_price_payload_rows",
    "s10_sentiment_payload_rows",
    "s18_s22_upsert_prices",
    "s19_incremental_fact",
    "m13_a2_a3_a4_p16_p17_vwap_bars_30s",
    "m13_vwap_bars_1h",
    "m11_w8_w9_fact_price_hourly",
    "m12_a8_market_ohlc",
    "w3_w5_rolling_chunked",
    "f13_p23_feature_matrix",
    "f15_sequence_samples",
    "l8_l10_trend_forecast",
    "l9_forecast_curve",
    "j7_match_predictions",
    "l11_a13_v7_accuracy_report",
    "a12_threshold_table",
    "q5_q6_q7_q8_silver_price_checks",
    "q2_q11_q12_q13_gold_checks",
    "v2_market_overview",
    "v5_realtime_ohlc",
    "t4_t6_stream_bars_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    runs = int(os.environ.get("BENCH_RUNS", "1"))

    def timed(name: str, folder: str) -> float:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    small = sf_dir.rstrip("/").replace("sf0.1", "sf0.01")
    times, growth = {}, {}
    for name in HEADLINE:
        first = timed(name, small)  # compiles; on the smaller tables where there are any
        before = timed(name, small) if small != sf_dir.rstrip("/") and os.path.isdir(small) else first
        times[name] = round(median(timed(name, sf_dir) for _ in range(runs)), 3)
        growth[name] = round(times[name] / before, 2)
        print(name, times[name], growth[name], file=sys.stderr, flush=True)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "growth": growth,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
