"""Shared tables of the SQL statements, in dependency order.

They restate the stand-in and lake tables in plain SQL over the test tables.
"""

BAND = """CASE WHEN {v} < 25 THEN 'Extreme Fear' WHEN {v} < 45 THEN 'Fear' WHEN {v} < 55 THEN 'Neutral'
 WHEN {v} < 75 THEN 'Greed' ELSE 'Extreme Greed' END"""

TABLES: dict[str, str] = {}

TABLES["hist"] = """
SELECT o.o_orderpriority AS coin_id, epoch_ms(o.o_orderdate) AS timestamp_ms, o.o_totalprice AS price_usd,
       c.c_acctbal AS market_cap_usd, v.vol AS volume_24h_usd, o.o_orderkey AS loaded,
       CAST(o.o_orderdate AS DATE) AS price_date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS vol FROM lineitem GROUP BY 1) v ON v.l_orderkey = o.o_orderkey
"""
TABLES["sent_raw"] = f"""
SELECT value, {BAND.format(v='value')} AS classification, CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp",
       CAST(l_shipdate AS DATE) AS index_date, l_orderkey * 20 + l_linenumber AS loaded
FROM (SELECT *, CAST(round(l_discount * 1000) AS INTEGER) AS value FROM lineitem)
"""
TABLES["s_prices"] = """
SELECT coin_id, price_date, price_usd,
       CASE WHEN market_cap_usd > 0 THEN market_cap_usd END AS market_cap_usd,
       CASE WHEN volume_24h_usd > 0 THEN volume_24h_usd END AS volume_24h_usd
FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, price_date ORDER BY loaded DESC) AS rn FROM hist)
WHERE rn = 1 AND price_usd > 0
"""
TABLES["s_sent"] = """
SELECT value AS fear_greed_value, classification, index_date
FROM (SELECT *, row_number() OVER (PARTITION BY index_date ORDER BY loaded DESC, "timestamp" DESC, value DESC) AS rn
      FROM sent_raw) WHERE rn = 1
"""
TABLES["stg"] = """
SELECT *, CASE WHEN prev_day_price > 0 THEN round((price_usd - prev_day_price) / prev_day_price * 100, 4) END
          AS price_change_pct_1d
FROM (SELECT *, lag(price_usd) OVER (PARTITION BY coin_id ORDER BY price_date) AS prev_day_price,
             CAST(row_number() OVER (PARTITION BY coin_id ORDER BY price_date DESC) AS INTEGER) AS recency_rank
      FROM s_prices)
"""
TABLES["stg_sent"] = """
SELECT *, CASE classification WHEN 'Extreme Fear' THEN 1 WHEN 'Fear' THEN 2 WHEN 'Neutral' THEN 3
                 WHEN 'Greed' THEN 4 WHEN 'Extreme Greed' THEN 5 END AS sentiment_score
FROM s_sent
"""
TABLES["daily"] = """
SELECT coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, price_change_pct_1d,
       avg(price_usd) OVER w7 AS moving_avg_7d, avg(price_usd) OVER w30 AS moving_avg_30d,
       stddev(price_usd) OVER w7 AS volatility_7d, avg(volume_24h_usd) OVER w7 AS avg_volume_7d
FROM stg
WINDOW w7 AS (PARTITION BY coin_id ORDER BY price_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY coin_id ORDER BY price_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
"""
TABLES["fact"] = """
SELECT coin_id, price_date, price_usd, market_cap_usd, volume_24h_usd, price_change_pct_1d, moving_avg_7d,
       moving_avg_30d, volatility_7d, avg_volume_7d, fear_greed_value, market_sentiment,
       CASE WHEN price_usd > moving_avg_30d THEN 'ABOVE_MA30' WHEN price_usd < moving_avg_30d THEN 'BELOW_MA30'
            ELSE 'AT_MA30' END AS ma30_signal,
       CASE WHEN price_usd < moving_avg_30d AND fear_greed_value < 25 THEN 'POTENTIAL_BUY'
            WHEN price_usd > moving_avg_30d AND fear_greed_value > 75 THEN 'POTENTIAL_SELL' ELSE 'HOLD' END
            AS combined_signal
FROM (SELECT d.coin_id, d.price_date, d.price_usd, d.market_cap_usd, d.volume_24h_usd, d.price_change_pct_1d,
             round(d.moving_avg_7d, 6) AS moving_avg_7d, round(d.moving_avg_30d, 6) AS moving_avg_30d,
             round(d.volatility_7d, 6) AS volatility_7d, round(d.avg_volume_7d, 2) AS avg_volume_7d,
             s.fear_greed_value, s.classification AS market_sentiment
      FROM daily d LEFT JOIN s_sent s ON d.price_date = s.index_date)
"""
TABLES["coins"] = """
SELECT coin_id, min(price_date) AS first_tracked_date, max(price_date) AS last_tracked_date,
       count(DISTINCT price_date) AS total_days_tracked, round(min(price_usd), 6) AS all_time_low,
       round(max(price_usd), 2) AS all_time_high, round(avg(price_usd), 6) AS avg_price,
       round(avg(volume_24h_usd), 2) AS avg_daily_volume, round(max(volume_24h_usd), 2) AS max_daily_volume,
       round(max(market_cap_usd), 2) AS max_market_cap,
       arg_max(market_cap_usd, price_date) FILTER (market_cap_usd IS NOT NULL) AS latest_market_cap,
       round((max(price_usd) - min(price_usd)) / nullif(min(price_usd), 0) * 100, 2) AS price_range_pct
FROM s_prices GROUP BY coin_id
"""
TABLES["dates"] = """
SELECT date_day, CAST(year(date_day) AS INTEGER) AS year, CAST(month(date_day) AS INTEGER) AS month,
       CAST(day(date_day) AS INTEGER) AS day_of_month, CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week,
       CAST(weekofyear(date_day) AS INTEGER) AS week_of_year, CAST(quarter(date_day) AS INTEGER) AS quarter,
       dayofweek(date_day) IN (0, 6) AS is_weekend, strftime(date_day, '%A') AS day_name,
       strftime(date_day, '%B') AS month_name
FROM (SELECT DISTINCT price_date AS date_day FROM s_prices)
"""
TABLES["trades"] = """
SELECT event_type AS coin_id, upper(event_type) AS symbol, value AS price_usd,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity, epoch_us(ts) // 1000 AS trade_time_ms,
       epoch_us(ts) // 1000 AS event_time_ms, epoch_ms(epoch_us(ts) // 1000) AS t, user_id % 2 = 0 AS is_buyer_maker,
       date_trunc('second', ts) AS ingested, event_id, user_id
FROM events
"""


def bars_sql(width: str) -> str:
    return f"""
SELECT coin_id, b AS window_start, b + INTERVAL '{width}' AS window_end, vwap, total_volume, avg_price, stddev_price,
       open, high, low, close, (vwap - avg_price) / nullif(stddev_price, 0) AS z_score,
       CASE WHEN abs((vwap - avg_price) / nullif(stddev_price, 0)) > 3 THEN 1 ELSE 0 END AS is_anomaly
FROM (SELECT coin_id, time_bucket(INTERVAL '{width}', t) AS b, sum(price_usd * quantity) / nullif(sum(quantity), 0) AS vwap,
             sum(quantity) AS total_volume, avg(price_usd) AS avg_price, stddev(price_usd) AS stddev_price,
             arg_min(price_usd, trade_time_ms) AS open, max(price_usd) AS high, min(price_usd) AS low,
             arg_max(price_usd, trade_time_ms) AS close
      FROM trades GROUP BY 1, 2)
"""


TABLES["bars30"] = bars_sql("30 seconds")
TABLES["bars1h"] = bars_sql("1 hour")
TABLES["hourly"] = """
SELECT coin_id, date_trunc('hour', t) AS price_hour, avg(price_usd) AS avg_price, min(price_usd) AS min_price,
       max(price_usd) AS max_price, arg_min(price_usd, trade_time_ms) AS open_price,
       arg_max(price_usd, trade_time_ms) AS close_price, sum(quantity) AS total_quantity, count(*) AS trade_count
FROM trades GROUP BY 1, 2
"""
TABLES["ohlc"] = """
SELECT coin_id, b AS bucket_start, timeframe, arg_min(price_usd, trade_time_ms) AS open, max(price_usd) AS high,
       min(price_usd) AS low, arg_max(price_usd, trade_time_ms) AS close, sum(quantity) AS volume
FROM (SELECT *, '1h' AS timeframe, date_trunc('hour', t) AS b FROM trades
      UNION ALL SELECT *, '4h', time_bucket(INTERVAL '4 hours', t) FROM trades
      UNION ALL SELECT *, '1d', CAST(date_trunc('day', t) AS TIMESTAMP) FROM trades) GROUP BY 1, 2, 3
"""
TABLES["ser"] = """
SELECT coin_id, ts, price, volume, pos, len, price - lag(price) OVER o AS delta, avg(price) OVER p AS mean_price
FROM (SELECT coin_id, window_start AS ts, "close" AS price, total_volume AS volume,
             row_number() OVER (PARTITION BY coin_id ORDER BY window_start) - 1 AS pos,
             count(*) OVER (PARTITION BY coin_id) AS len FROM bars30)
WINDOW o AS (PARTITION BY coin_id ORDER BY pos), p AS (PARTITION BY coin_id)
"""
TABLES["steps"] = """
SELECT *, avg(gain) OVER g7 AS gs7, avg(loss) OVER g7 AS ls7, avg(gain) OVER g14 AS gs14, avg(loss) OVER g14 AS ls14
FROM (SELECT *, greatest(coalesce(delta, 0), 0) AS gain, greatest(coalesce(-delta, 0), 0) AS loss FROM ser)
WINDOW g7 AS (PARTITION BY coin_id ORDER BY pos ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       g14 AS (PARTITION BY coin_id ORDER BY pos ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
"""
TABLES["smooth"] = """
SELECT coin_id, pos, price AS e12, price AS e26, CAST(0 AS DOUBLE) AS sig, CAST(0 AS DOUBLE) AS g7,
       CAST(0 AS DOUBLE) AS l7, CAST(0 AS DOUBLE) AS g14, CAST(0 AS DOUBLE) AS l14
FROM steps WHERE pos = 0
UNION ALL
SELECT s.coin_id, s.pos, 2.0 / 13 * s.price + 11.0 / 13 * r.e12, 2.0 / 27 * s.price + 25.0 / 27 * r.e26,
       0.2 * ((2.0 / 13 * s.price + 11.0 / 13 * r.e12) - (2.0 / 27 * s.price + 25.0 / 27 * r.e26)) + 0.8 * r.sig,
       CASE WHEN s.pos < 7 THEN 0 WHEN s.pos = 7 THEN s.gs7 ELSE (r.g7 * 6 + s.gain) / 7 END,
       CASE WHEN s.pos < 7 THEN 0 WHEN s.pos = 7 THEN s.ls7 ELSE (r.l7 * 6 + s.loss) / 7 END,
       CASE WHEN s.pos < 14 THEN 0 WHEN s.pos = 14 THEN s.gs14 ELSE (r.g14 * 13 + s.gain) / 14 END,
       CASE WHEN s.pos < 14 THEN 0 WHEN s.pos = 14 THEN s.ls14 ELSE (r.l14 * 13 + s.loss) / 14 END
FROM smooth r JOIN steps s ON s.coin_id = r.coin_id AND s.pos = r.pos + 1
"""
_RETURNS = ",\n".join(
    f"CASE WHEN pos >= {k} THEN greatest(-0.5, least(0.5, (price - lag(price, {k}) OVER o) / (lag(price, {k}) OVER o + 1e-10)))"
    f" ELSE 0 END AS return_{k}"
    for k in (1, 3, 5, 10)
)
_MOMENTA = ",\n".join(f"(price - lag(price, {k}) OVER o) / (lag(price, {k}) OVER o + 1e-10) AS mom_{k}" for k in (5, 10))


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY coin_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _previous(n: int) -> str:
    return f"OVER (PARTITION BY coin_id ORDER BY pos ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


TABLES["feat0"] = f"""
SELECT *, {_RETURNS}, {_MOMENTA}, lead(price, 3) OVER o AS future_price,
       avg(price) {_frame(20)} AS mid, stddev_pop(price) {_frame(20)} AS sd,
       avg(volume) {_previous(5)} AS va5, avg(volume) {_previous(10)} AS va10,
       avg(price) {_frame(5)} AS sma5, avg(price) {_frame(10)} AS sma10
FROM ser WINDOW o AS (PARTITION BY coin_id ORDER BY pos)
"""
TABLES["feat1"] = f"""
SELECT *, stddev_pop(return_1) {_frame(5)} AS vol5, stddev_pop(return_1) {_frame(10)} AS vol10,
       stddev_pop(return_1) {_frame(20)} AS vol20,
       CASE WHEN sd > 0 THEN greatest(0, least(1, (price - (mid - 2 * sd)) / (4 * sd + 1e-10))) ELSE 0.5 END AS bb,
       CASE WHEN va5 > 0 THEN volume / va5 ELSE 1 END AS vr5, CASE WHEN va10 > 0 THEN volume / va10 ELSE 1 END AS vr10,
       CASE WHEN pos >= 2 THEN avg(return_1) {_frame(3)} ELSE 0 END AS m3,
       CASE WHEN pos >= 4 THEN avg(return_1) {_frame(5)} ELSE 0 END AS m5,
       CASE WHEN pos >= 9 THEN avg(return_1) {_frame(10)} ELSE 0 END AS m10,
       CASE WHEN pos >= 9 THEN stddev_pop(return_1) {_frame(10)} ELSE 0.001 END AS recent_vol
FROM feat0
"""


def _fill(value: str, row: int) -> str:
    return f"CASE WHEN pos < {row} THEN max(CASE WHEN pos = {row} THEN {value} END) OVER p ELSE {value} END"


TABLES["windowed"] = f"""
SELECT coin_id, ts, price, volume, pos, len, future_price, return_1, return_3, return_5, return_10,
       {_fill('vol5', 5)} AS volatility_5, {_fill('vol10', 10)} AS volatility_10, {_fill('vol20', 20)} AS volatility_20,
       {_fill('bb', 20)} AS bb_position,
       greatest(0, least(5, {_fill('vr5', 5)})) / 5 AS volume_ratio_5,
       greatest(0, least(5, {_fill('vr10', 10)})) / 5 AS volume_ratio_10,
       greatest(-0.5, least(0.5, {_fill('mom_5', 5)})) AS momentum_5,
       greatest(-0.5, least(0.5, {_fill('mom_10', 10)})) AS momentum_10,
       {_fill('sma5', 4)} AS sma_5, {_fill('sma10', 9)} AS sma_10,
       0.5 * m3 + 0.3 * m5 + 0.2 * m10 AS trend_momentum, recent_vol, mean_price
FROM feat1 WINDOW p AS (PARTITION BY coin_id)
"""
TABLES["feats"] = """
SELECT w.*, CASE WHEN w.pos > 7 THEN 100 - 100 / (1 + m.g7 / (m.l7 + 1e-10)) END AS rsi_raw_7,
       CASE WHEN w.pos > 14 THEN 100 - 100 / (1 + m.g14 / (m.l14 + 1e-10)) END AS rsi_raw_14,
       CASE WHEN w.pos > 7 THEN 100 - 100 / (1 + m.g7 / (m.l7 + 1e-10)) ELSE 50 END / 100 AS rsi_7,
       CASE WHEN w.pos > 14 THEN 100 - 100 / (1 + m.g14 / (m.l14 + 1e-10)) ELSE 50 END / 100 AS rsi_14,
       greatest(-0.1, least(0.1, (m.e12 - m.e26) / mean_price)) AS macd,
       greatest(-0.1, least(0.1, m.sig / mean_price)) AS macd_signal,
       greatest(-0.1, least(0.1, (m.e12 - m.e26 - m.sig) / mean_price)) AS macd_hist,
       greatest(-1, least(1, (coalesce(s.fear_greed_value, 50) - 50) / 50.0)) AS fear_greed_norm,
       sin(2 * pi() * (hour(w.ts) + minute(w.ts) / 60.0) / 24) AS hour_sin,
       cos(2 * pi() * (hour(w.ts) + minute(w.ts) / 60.0) / 24) AS hour_cos
FROM windowed w JOIN smooth m ON w.coin_id = m.coin_id AND w.pos = m.pos
LEFT JOIN s_sent s ON s.index_date = CAST(w.ts AS DATE)
"""
TABLES["votes"] = """
SELECT coin_id, ts, price, pos, len, future_price, trend_momentum, recent_vol, rsi_7, bb_position, sma_5,
       greatest(0, least(1, 0.5 + return_1)) AS gb_prob, bb_position AS rf_prob,
       CASE WHEN volume_ratio_5 > 0.1 THEN rsi_7 END AS lstm_prob
FROM feats
"""
TABLES["blended"] = """
SELECT *, abs(direction_prob - 0.5) * 2 AS ml_confidence FROM
 (SELECT *, (0.45 * gb_prob + 0.35 * rf_prob + CASE WHEN lstm_prob IS NOT NULL THEN 0.20 * lstm_prob ELSE 0 END)
          / (0.45 + 0.35 + CASE WHEN lstm_prob IS NOT NULL THEN 0.20 ELSE 0 END) AS direction_prob FROM votes)
"""
TABLES["forecasted"] = """
SELECT *, price * (1 + predicted_return) AS predicted_price,
       CASE WHEN price * (1 + predicted_return) > price THEN 'Bullish'
            WHEN price * (1 + predicted_return) < price THEN 'Bearish' ELSE 'Neutral' END AS sentiment_bias
FROM (SELECT *, greatest(-0.003, least(0.003, base * continuation_factor + mean_reversion * abs(trend_momentum)))
              AS predicted_return, greatest(0.1, strength * 0.6 + ml_confidence * 0.4) AS confidence
      FROM (SELECT *, CASE WHEN (trend_momentum > 0) = (direction_prob > 0.5) AND strength > 0.2 THEN 1 + 0.3 * strength
                           WHEN (trend_momentum > 0) <> (direction_prob > 0.5) AND strength > 0.3
                             THEN greatest(0.3, 1 - 0.5 * strength) ELSE 1 END AS continuation_factor,
                   CASE WHEN rsi_7 * 100 > 70 OR bb_position > 0.9 THEN -0.3
                        WHEN rsi_7 * 100 < 30 OR bb_position < 0.1 THEN 0.3 ELSE 0 END AS mean_reversion,
                   CASE WHEN direction_prob > 0.5 THEN 1 ELSE -1 END * greatest(recent_vol, 0.0001)
                     * (0.3 + 0.7 * ml_confidence) AS base
            FROM (SELECT *, least(abs(trend_momentum) / 0.002, 1) AS strength FROM blended)))
"""
TABLES["preds"] = """
SELECT 'ensemble' AS model, coin_id, ts, predicted_price, price AS current_price, confidence, sentiment_bias
FROM forecasted
UNION ALL
SELECT 'legacy', coin_id, ts, sma_5, price, CAST(0.5 AS DOUBLE), CASE WHEN sma_5 > price THEN 'Bullish' ELSE 'Bearish' END
FROM feats
"""
TABLES["errs"] = """
SELECT *, abs(predicted_price - matched_close) AS abs_error,
       abs(predicted_price - matched_close) / nullif(matched_close, 0) * 100 AS pct_error,
       (predicted_price > current_price) = (matched_close > current_price) AS direction_correct
FROM (SELECT p.model, p.coin_id, p.ts, p.predicted_price, p.current_price, min(b.window_start) AS matched_ts,
             arg_min(b."close", b.window_start) AS matched_close
      FROM preds p JOIN bars30 b ON b.coin_id = p.coin_id AND b.window_start >= p.ts + INTERVAL '60 seconds'
        AND b.window_start <= p.ts + INTERVAL '300 seconds'
      GROUP BY 1, 2, 3, 4, 5)
"""
TABLES["report"] = """
SELECT model, count(*) AS total_evaluated, round(avg(abs_error), 2) AS mae, round(avg(pct_error), 4) AS mape,
       round(avg(CASE WHEN direction_correct THEN 1.0 ELSE 0 END) * 100, 1) AS direction_accuracy,
       count(*) FILTER (direction_correct) AS correct_direction
FROM errs GROUP BY 1
"""
TABLES["dsteps"] = """
SELECT *, row_number() OVER (PARTITION BY model, coin_id ORDER BY ts) - 1 AS pos FROM preds
"""
TABLES["dsmooth"] = """
SELECT model, coin_id, ts, pos, predicted_price AS ema FROM dsteps WHERE pos = 0
UNION ALL
SELECT s.model, s.coin_id, s.ts, s.pos, s.predicted_price / 3 + r.ema * 2 / 3 FROM dsmooth r
JOIN dsteps s ON s.model = r.model AND s.coin_id = r.coin_id AND s.pos = r.pos + 1
"""
