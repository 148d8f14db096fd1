"""Parts of the SQL that several queries share."""

from quotemill.sources.standin import BARS_SQL, CANDLES_SQL

FEATURES_SQL = (
    BARS_SQL
    + """, prev AS (
  SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev_close FROM bars
), ranged AS (
  SELECT *, close - prev_close AS change,
    greatest(coalesce(abs(high - low), 0), coalesce(abs(high - prev_close), 0), coalesce(abs(low - prev_close), 0)) AS range_zero,
    greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS range_skip,
    CASE WHEN prev_close IS NOT NULL THEN greatest(high - low, abs(high - prev_close), abs(low - prev_close)) END AS range_null
  FROM prev
), strengths AS (
  SELECT *,
    CASE WHEN count(change) OVER w >= 14 THEN sum(greatest(change, 0)) OVER w::DOUBLE / 14 END AS gain,
    CASE WHEN count(change) OVER w >= 14 THEN sum(greatest(-change, 0)) OVER w::DOUBLE / 14 END AS loss
  FROM ranged WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
), features AS (
  SELECT *,
    (close::DOUBLE / nullif(lag(close, 20) OVER s, 0)::DOUBLE - 1) * 100 AS mom_20,
    CASE WHEN count(range_zero) OVER w >= 14 THEN sum(range_zero) OVER w::DOUBLE / count(range_zero) OVER w END AS atr_14,
    round(100 - 100 / (1 + gain / nullif(loss, 0)), 6) AS rsi_14,
    max(high) OVER (PARTITION BY symbol ORDER BY trade_date RANGE BETWEEN INTERVAL 20 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS prior_high
  FROM strengths
  WINDOW s AS (PARTITION BY symbol ORDER BY trade_date), w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
)"""
)

SIGNALS_SQL = (
    FEATURES_SQL
    + """, main AS (SELECT * FROM features WHERE mkt_flag = 0 AND ind_sec = 'N'
), momentum AS (
  SELECT trade_date, symbol, 'momentum' AS strategy, CASE WHEN mom_20 >= 0 THEN 'LONG' ELSE 'SHORT' END AS signal_type, mom_20 AS signal_score, 'next_open' AS entry_model,
    NULL::DOUBLE AS entry_price, NULL::DOUBLE AS stop_price, NULL::DOUBLE AS target_price, 5 AS expected_hold_days
  FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY abs(mom_20) DESC, symbol) AS nth FROM main WHERE mom_20 IS NOT NULL) WHERE nth <= 20
), gaps AS (
  SELECT trade_date, symbol, 'gap' AS strategy, CASE WHEN gap_pct > 0 THEN 'LONG' ELSE 'SHORT' END AS signal_type, gap_pct AS signal_score, 'open' AS entry_model,
    open::DOUBLE AS entry_price, NULL::DOUBLE AS stop_price, NULL::DOUBLE AS target_price, 1 AS expected_hold_days
  FROM (SELECT *, (open - prev_close)::DOUBLE / nullif(prev_close, 0)::DOUBLE * 100 AS gap_pct FROM main) WHERE abs(gap_pct) >= {gap}
), breakouts AS (
  SELECT trade_date, symbol, 'breakout' AS strategy, 'LONG' AS signal_type, coalesce((close - prior_high)::DOUBLE / nullif(prior_high, 0)::DOUBLE, 0) AS signal_score, 'next_open' AS entry_model,
    close::DOUBLE AS entry_price, round(close::DOUBLE - atr_14 * 1.5::DOUBLE, 6) AS stop_price, round(close::DOUBLE + atr_14 * 3.0::DOUBLE, 6) AS target_price, 10 AS expected_hold_days
  FROM main WHERE close > prior_high AND atr_14 IS NOT NULL
), signals AS (SELECT * FROM momentum UNION ALL SELECT * FROM gaps UNION ALL SELECT * FROM breakouts)"""
)

PRICED_SQL = (
    SIGNALS_SQL
    + """, entries AS (
  SELECT s.* EXCLUDE (entry_price), CASE WHEN entry_model = 'next_open' THEN s.trade_date + 1 ELSE s.trade_date END AS entry_date FROM signals s
), entered AS (
  SELECT e.*, coalesce(o.open, t.close) AS entry_dec, coalesce(o.open, t.close)::DOUBLE AS entry_price,
    CASE WHEN o.open IS NOT NULL THEN 'entry_open' WHEN t.close IS NOT NULL THEN 'trade_close_fallback' END AS entry_source
  FROM entries e LEFT JOIN bars o ON o.symbol = e.symbol AND o.trade_date = e.entry_date LEFT JOIN bars t ON t.symbol = e.symbol AND t.trade_date = e.trade_date
), known AS (
  SELECT e.*, f.atr_14, f.prev_close, CASE WHEN signal_type = 'SHORT' THEN -1 ELSE 1 END AS sign,
    strategy IN ('momentum', 'gap') AND entry_price IS NOT NULL AS ours,
    CASE WHEN strategy = 'gap' THEN coalesce(f.prev_close::DOUBLE, entry_price) ELSE entry_price END AS anchor
  FROM entered e LEFT JOIN features f ON f.symbol = e.symbol AND f.trade_date = e.trade_date
), priced AS (
  SELECT symbol, trade_date, strategy, signal_type, signal_score, entry_model, entry_date, entry_price, entry_source, expected_hold_days,
    CASE WHEN stop_price IS NOT NULL AND stop_price <> 0 THEN stop_price WHEN ours
      THEN coalesce(round(anchor - sign * atr_14 * 1.5::DOUBLE, 4), round(entry_dec + (entry_dec * sign * -5)::DECIMAL(24,2) * 0.001, 4)::DOUBLE) ELSE stop_price END AS stop_price,
    CASE WHEN target_price IS NOT NULL AND target_price <> 0 THEN target_price WHEN ours
      THEN coalesce(round(entry_price + sign * atr_14 * 3.0::DOUBLE, 4), round(entry_dec + (entry_dec * sign * 10)::DECIMAL(24,2) * 0.001, 4)::DOUBLE) ELSE target_price END AS target_price,
    ours AND coalesce(stop_price = 0, TRUE) AS stop_imputed, ours AND coalesce(target_price = 0, TRUE) AS target_imputed,
    CASE WHEN ours THEN CASE WHEN atr_14 IS NOT NULL THEN 'atr' ELSE 'percent' END END AS method
  FROM known
)"""
)

LABELS_SQL = (
    PRICED_SQL
    + """, barred AS (
  SELECT p.*, b.open::DOUBLE AS bo, b.high::DOUBLE AS bh, b.low::DOUBLE AS bl, b.close::DOUBLE AS bc, b.symbol IS NOT NULL AS has_bar, signal_type AS side, coalesce(entry_price, b.open::DOUBLE) AS entry_used
  FROM priced p LEFT JOIN bars b ON b.symbol = p.symbol AND b.trade_date = p.trade_date
), hits AS (
  SELECT *, entry_used IS NOT NULL AND bh IS NOT NULL AND bl IS NOT NULL AND bc IS NOT NULL AS whole,
    coalesce(CASE WHEN side = 'LONG' THEN bh >= target_price ELSE bl <= target_price END, FALSE) AS hit_target,
    coalesce(CASE WHEN side = 'LONG' THEN bl <= stop_price ELSE bh >= stop_price END, FALSE) AS hit_stop
  FROM barred
), exits AS (
  SELECT *, (whole AND hit_target AND hit_stop)::INT AS ambiguous,
    CASE WHEN NOT whole OR (hit_target AND hit_stop) THEN 'neutral' WHEN hit_target THEN 'win' WHEN hit_stop THEN 'loss' ELSE 'neutral' END AS label,
    CASE WHEN NOT whole OR (hit_target AND hit_stop) THEN NULL WHEN hit_target THEN target_price WHEN hit_stop THEN stop_price ELSE bc END AS exit_price,
    CASE WHEN NOT whole OR (hit_target AND hit_stop) THEN NULL WHEN hit_target THEN 'target' WHEN hit_stop THEN 'stop' ELSE 'close' END AS exit_reason
  FROM hits
), labels AS (
  SELECT *, CASE WHEN side = 'LONG' THEN exit_price - entry_used ELSE entry_used - exit_price END / nullif(entry_used, 0) * 100 AS realized_return FROM exits
)"""
)

METRICS_SQL = (
    FEATURES_SQL
    + """, averaged AS (
  SELECT *, coalesce(sum(net_trdqty) OVER w::DOUBLE / count(net_trdqty) OVER w, net_trdqty::DOUBLE) AS avg_20d_vol, sum(net_trdval) OVER w::DOUBLE / count(net_trdval) OVER w AS avg_20d_val
  FROM features WINDOW w AS (PARTITION BY symbol ORDER BY trade_date RANGE BETWEEN INTERVAL 40 DAY PRECEDING AND CURRENT ROW)
), metrics AS (
  SELECT symbol, trade_date, net_trdval::DOUBLE AS net_trdval, net_trdqty, trades, close::DOUBLE AS close, avg_20d_vol, avg_20d_val,
    (rank() OVER (PARTITION BY trade_date ORDER BY net_trdval) + (count(*) OVER (PARTITION BY trade_date, net_trdval) - 1)::DOUBLE / 2) / count(*) OVER (PARTITION BY trade_date) AS turnover_rank_pct,
    CASE WHEN max(net_trdval) OVER d > 0 THEN net_trdval::DOUBLE / max(net_trdval) OVER d::DOUBLE ELSE 0 END AS turnover_norm,
    CASE WHEN max(avg_20d_vol) OVER d > 0 THEN avg_20d_vol / max(avg_20d_vol) OVER d ELSE 0 END AS vol_norm, FALSE AS fno_flag
  FROM averaged WINDOW d AS (PARTITION BY trade_date)
)"""
)

VWAP_SQL = (
    CANDLES_SQL
    + """, vwaps AS (
  SELECT *, sum(high + low + close) OVER w::DOUBLE / (count(*) OVER w * 3) AS vwap_equal, sum((high + low + close) * volume) OVER w::DOUBLE / (sum(volume) OVER w * 3)::DOUBLE AS vwap_volume
  FROM candles WINDOW w AS (PARTITION BY session ORDER BY ts ROWS UNBOUNDED PRECEDING)
), crosses AS (
  SELECT *, close::DOUBLE - vwap_equal AS gap, coalesce((lag(close::DOUBLE - vwap_equal) OVER (PARTITION BY session ORDER BY ts)) * (close::DOUBLE - vwap_equal) < 0, FALSE) AS crossed FROM vwaps
)"""
)

OUTCOMES_SQL = (
    BARS_SQL
    + """, moves AS (
  SELECT symbol, trade_date, high > low AS ranged, (high - open)::DOUBLE / nullif(open, 0)::DOUBLE * 100 AS up_pct, (low - open)::DOUBLE / nullif(open, 0)::DOUBLE * 100 AS down_pct, (high - low)::DOUBLE / nullif(open, 0)::DOUBLE * 100 AS range_pct FROM bars
), outcomes AS (
  SELECT *, CASE WHEN up_pct IS NULL THEN NULL WHEN up_pct >= 1.5 THEN 'SUCCESS' WHEN down_pct <= -1.0 THEN 'FAILURE' ELSE 'CHOP' END AS outcome FROM moves
)"""
)

SELECTION_SQL = (
    OUTCOMES_SQL
    + """, candidates AS (
  SELECT trade_date, symbol, row_number() OVER (PARTITION BY trade_date ORDER BY net_trdval DESC, symbol) <= 5 AS selected FROM bars
), joined AS (
  SELECT c.trade_date, c.symbol, c.selected, o.outcome FROM candidates c LEFT JOIN (SELECT * FROM outcomes WHERE ranged) o USING (trade_date, symbol)
), classified AS (
  SELECT *, CASE WHEN selected THEN CASE outcome WHEN 'SUCCESS' THEN 'GOOD_SELECTION' WHEN 'FAILURE' THEN 'BAD_SELECTION' ELSE 'CHOP' END
    ELSE CASE WHEN outcome = 'SUCCESS' THEN 'MISSED_OPPORTUNITY' ELSE 'CORRECT_REJECTION' END END AS classification FROM joined
), counted AS (
  SELECT trade_date, count(*) AS candidate_count, count(*) FILTER (selected) AS selected_count, count(*) FILTER (classification = 'GOOD_SELECTION') AS good_selection,
    count(*) FILTER (classification = 'BAD_SELECTION') AS bad_selection, count(*) FILTER (classification = 'MISSED_OPPORTUNITY') AS missed_opportunity,
    count(*) FILTER (classification = 'CORRECT_REJECTION') AS correct_rejection
  FROM classified GROUP BY trade_date
), daily AS (
  SELECT *, CASE WHEN selected_count > 0 THEN good_selection::DOUBLE / selected_count ELSE 0 END AS conversion_rate, CASE WHEN selected_count > 0 THEN bad_selection::DOUBLE / selected_count ELSE 0 END AS failure_rate,
    CASE WHEN candidate_count > 0 THEN missed_opportunity::DOUBLE / candidate_count ELSE 0 END AS missed_opportunity_rate
  FROM counted
)"""
)
