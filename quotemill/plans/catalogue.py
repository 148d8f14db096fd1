"""The query catalogue: each query as a DataFrame, and the SQL that must give the same rows."""

from __future__ import annotations

import io
import os
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotemill.functions import coerce, names
from quotemill.operators import candidates, hold, indicators, instruments, labels, liquidity, risk, scans, selection, sessions, signals, trading_days
from quotemill.plans.fragments import CANDLES_SQL, FEATURES_SQL, LABELS_SQL, METRICS_SQL, OUTCOMES_SQL, PRICED_SQL, SELECTION_SQL, SIGNALS_SQL, VWAP_SQL
from quotemill.plans.queries import ORACLE, QUERIES, query
from quotemill.sources import archive, store
from quotemill.sources.standin import BARS_SQL, PART_ROWS, bars, candles, candles_of, symbol_of
from quotemill.sources.table_io import shared_dir, staged, table
from quotemill.streaming import candles as streams

#: The stand-in prices jump, so that a gap of 2 percent would keep nearly every bar.
GAP = 200.0
#: The stand-in's barriers, for hold days that differ.
TARGET, STOP = 3.0, 0.95


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.with_features(bars(spark, sf_dir))


def features_once(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Some columns of features in the shared folder, for plans that read them more than once."""
    return staged(features(spark, sf_dir).select("symbol", "trade_date", *columns), "features")


#: What signals and their prices are made of.
SIGNALLED = ("open", "close", "mkt_flag", "ind_sec", "prev_close", "mom_20", "atr_14", "prior_high")


def doubles(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def series():
    return indicators.series()


OHLC = ("open", "high", "low", "close")

# bars and indicators


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, net_trdval::DOUBLE AS net_trdval, net_trdqty, trades, mkt_flag, ind_sec FROM bars")
def bars_daily(spark, sf_dir):
    return doubles(bars(spark, sf_dir).drop("day"), *OHLC, "net_trdval")


@query(f"WITH {FEATURES_SQL} SELECT symbol, trade_date, prev_close::DOUBLE AS prev_close, (open - prev_close)::DOUBLE / nullif(prev_close, 0)::DOUBLE * 100 AS gap_pct FROM features")
def prev_close_gap(spark, sf_dir):
    df = bars(spark, sf_dir).withColumn("prev_close", indicators.previous(F.col("close"), series()))
    return df.select("symbol", "trade_date", F.col("prev_close").cast("double").alias("prev_close"), signals.gap_percent(F.col("open"), F.col("prev_close")).alias("gap_pct"))


def _range(spark, sf_dir, how) -> DataFrame:
    df = bars(spark, sf_dir).withColumn("prev_close", indicators.previous(F.col("close"), series()))
    return df.withColumn("true_range", how(F.col("high"), F.col("low"), F.col("prev_close")))


def _range_sql(name: str) -> str:
    return f"WITH {FEATURES_SQL} SELECT symbol, trade_date, {name}::DOUBLE AS true_range FROM features"


@query(_range_sql("range_zero"))
def true_range_zero_fill(spark, sf_dir):
    return doubles(_range(spark, sf_dir, indicators.range_zero_fill), "true_range").select("symbol", "trade_date", "true_range")


@query(_range_sql("range_skip"))
def true_range_skip_null(spark, sf_dir):
    return doubles(_range(spark, sf_dir, indicators.range_skip_null), "true_range").select("symbol", "trade_date", "true_range")


@query(_range_sql("range_null"))
def true_range_propagate_null(spark, sf_dir):
    return doubles(_range(spark, sf_dir, indicators.range_propagate_null), "true_range").select("symbol", "trade_date", "true_range")


def _atr_sql(name: str, need: int) -> str:
    return f"""WITH {FEATURES_SQL} SELECT symbol, trade_date, CASE WHEN count({name}) OVER w >= {need} THEN sum({name}) OVER w::DOUBLE / count({name}) OVER w END AS atr
    FROM features WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"""


def _atr(spark, sf_dir, how, need) -> DataFrame:
    return _range(spark, sf_dir, how).select("symbol", "trade_date", indicators.rolling_mean(F.col("true_range"), series(), 14, need).alias("atr"))


@query(_atr_sql("range_zero", 14))
def atr_full_window(spark, sf_dir):
    return _atr(spark, sf_dir, indicators.range_zero_fill, 14)


@query(_atr_sql("range_skip", 7))
def atr_min_periods(spark, sf_dir):
    return _atr(spark, sf_dir, indicators.range_skip_null, 7)


@query(_atr_sql("range_null", 14))
def atr_candles(spark, sf_dir):
    return _atr(spark, sf_dir, indicators.range_propagate_null, 14)


@query(f"WITH {FEATURES_SQL} SELECT symbol, trade_date, rsi_14 AS rsi FROM features")
def rsi_null_on_zero_loss(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "trade_date", F.round(indicators.rsi_null_on_zero_loss(F.col("close"), series()), 6).alias("rsi"))


@query(f"WITH {FEATURES_SQL} SELECT symbol, trade_date, round(100 - 100 / (1 + gain / (loss + 0.00000001::DOUBLE)), 6) AS rsi FROM features")
def rsi_epsilon(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "trade_date", F.round(indicators.rsi_epsilon(F.col("close"), series()), 6).alias("rsi"))


@query(
    f"""WITH {BARS_SQL} SELECT symbol, trade_date,
    CASE WHEN count(close) OVER a >= 5 THEN sum(close) OVER a::DOUBLE / 5 END AS sma_5, CASE WHEN count(close) OVER b >= 20 THEN sum(close) OVER b::DOUBLE / 20 END AS sma_20 FROM bars
    WINDOW a AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), b AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""
)
def sma_pair(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "trade_date", indicators.rolling_mean(F.col("close"), series(), 5).alias("sma_5"), indicators.rolling_mean(F.col("close"), series(), 20).alias("sma_20"))


@query(f"WITH {FEATURES_SQL} SELECT symbol, trade_date, mom_20 FROM features")
def momentum_pct(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "trade_date", indicators.momentum(F.col("close"), series()).alias("mom_20"))


@query(f"WITH {FEATURES_SQL} SELECT symbol, trade_date, prior_high::DOUBLE AS prior_high FROM features")
def prior_range_high(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "trade_date", indicators.high_before(F.col("high"), series()).cast("double").alias("prior_high"))


@query(f"WITH {METRICS_SQL} SELECT symbol, trade_date, avg_20d_vol FROM metrics")
def avg_volume_range(spark, sf_dir):
    return bars(spark, sf_dir).select("symbol", "trade_date", indicators.mean_of_days(F.col("net_trdqty"), series()).alias("avg_20d_vol"))


@query(
    f"""WITH {FEATURES_SQL} SELECT trade_date, symbol, 'mom_20' AS feature_name, mom_20 AS value FROM features WHERE mom_20 IS NOT NULL
    UNION ALL SELECT trade_date, symbol, 'atr_14', atr_14 FROM features WHERE atr_14 IS NOT NULL UNION ALL SELECT trade_date, symbol, 'rsi_14', rsi_14 FROM features WHERE rsi_14 IS NOT NULL"""
)
def feature_long(spark, sf_dir):
    return indicators.long_features(features(spark, sf_dir))


_CANDLE_SERIES = (
    VWAP_SQL
    + """, changes AS (SELECT *, lag(close) OVER (ORDER BY ts) AS pc, close - lag(close) OVER (ORDER BY ts) AS change FROM candles
), wide AS (SELECT *, CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr FROM changes
), full_ AS (SELECT session, ts, close::DOUBLE AS close,
    CASE WHEN count(close) OVER (ORDER BY ts ROWS 4 PRECEDING) >= 5 THEN sum(close) OVER (ORDER BY ts ROWS 4 PRECEDING)::DOUBLE / 5 END AS sma_5,
    CASE WHEN count(close) OVER (ORDER BY ts ROWS 19 PRECEDING) >= 20 THEN sum(close) OVER (ORDER BY ts ROWS 19 PRECEDING)::DOUBLE / 20 END AS sma_20,
    CASE WHEN count(change) OVER w >= 14 THEN 100 - 100 / (1 + sum(greatest(change, 0)) OVER w::DOUBLE / 14 / (sum(greatest(-change, 0)) OVER w::DOUBLE / 14 + 0.00000001::DOUBLE)) END AS rsi,
    CASE WHEN count(tr) OVER w >= 14 THEN sum(tr) OVER w::DOUBLE / 14 END AS atr FROM wide WINDOW w AS (ORDER BY ts ROWS 13 PRECEDING))"""
)


@query(f"WITH {_CANDLE_SERIES} SELECT session, ts, close, sma_5, sma_20, round(rsi, 6) AS rsi, atr FROM full_ WHERE sma_20 IS NOT NULL AND rsi IS NOT NULL AND atr IS NOT NULL")
def candle_indicators(spark, sf_dir):
    df = indicators.candle_indicators(candles(spark, sf_dir))
    return df.select("session", "ts", F.col("close").cast("double").alias("close"), "sma_5", "sma_20", F.round("rsi", 6).alias("rsi"), "atr")


# signals, prices, labels

_SIGNAL = "trade_date, symbol, strategy, signal_type, signal_score, entry_model, entry_price, stop_price, target_price, expected_hold_days"


def _signals_sql(name: str, gap: float = GAP) -> str:
    return f"WITH {SIGNALS_SQL.format(gap=gap)} SELECT {_SIGNAL} FROM {name}"


def _all(spark, sf_dir) -> DataFrame:
    return signals.all_signals(features(spark, sf_dir), gap=GAP)


@query(_signals_sql("momentum"))
def signals_momentum_topn(spark, sf_dir):
    return signals.momentum_signals(features(spark, sf_dir)).drop("version")


@query(_signals_sql("gaps"))
def signals_gap(spark, sf_dir):
    return signals.gap_signals(features(spark, sf_dir), GAP).drop("version")


@query(_signals_sql("breakouts"))
def signals_breakout(spark, sf_dir):
    return signals.breakout_signals(features(spark, sf_dir)).drop("version")


@query(f"WITH {SIGNALS_SQL.format(gap=GAP)} SELECT strategy, count(*) AS signals, count(DISTINCT trade_date) AS days FROM signals GROUP BY strategy")
def signals_union(spark, sf_dir):
    return _all(spark, sf_dir).groupBy("strategy").agg(F.count("*").alias("signals"), F.countDistinct("trade_date").alias("days"))


@query(f"WITH {SIGNALS_SQL.format(gap=GAP)} SELECT trade_date, symbol, strategy, CASE WHEN signal_score >= 0 THEN 'LONG' ELSE 'SHORT' END AS signal_type, signal_type <> CASE WHEN signal_score >= 0 THEN 'LONG' ELSE 'SHORT' END AS repaired FROM signals")
def signal_type_repair(spark, sf_dir):
    right = signals.repaired_type(F.col("signal_score"))
    return _all(spark, sf_dir).select("trade_date", "symbol", "strategy", right.alias("signal_type"), (F.col("signal_type") != right).alias("repaired"))


@query(f"WITH {PRICED_SQL.format(gap=GAP)} SELECT trade_date, symbol, strategy, entry_date, entry_price, entry_source FROM entered")
def signal_entry_prices(spark, sf_dir):
    f = features_once(spark, sf_dir, *SIGNALLED)
    df = risk.with_entries(signals.all_signals(f, gap=GAP), f)
    return doubles(df, "entry_price").select("trade_date", "symbol", "strategy", "entry_date", "entry_price", "entry_source")


def _priced(spark, sf_dir) -> DataFrame:
    return doubles(risk.priced(features(spark, sf_dir), gap=GAP), "entry_price")


@query(f"WITH {PRICED_SQL.format(gap=GAP)} SELECT trade_date, symbol, strategy, entry_date, entry_source, entry_price, stop_price, target_price FROM priced")
def signal_prices_joined(spark, sf_dir):
    """The same prices by joins, for signals that come from elsewhere."""
    f = features_once(spark, sf_dir, *SIGNALLED)
    df = doubles(risk.with_risk(risk.with_entries(signals.all_signals(f, gap=GAP), f), f), "entry_price")
    return df.select("trade_date", "symbol", "strategy", "entry_date", "entry_source", "entry_price", "stop_price", "target_price")


@query(f"WITH {PRICED_SQL.format(gap=GAP)} SELECT trade_date, symbol, strategy, signal_type, entry_price, stop_price, target_price, stop_imputed, target_imputed, method FROM priced")
def signal_stops_targets(spark, sf_dir):
    return _priced(spark, sf_dir).select("trade_date", "symbol", "strategy", "signal_type", "entry_price", "stop_price", "target_price", "stop_imputed", "target_imputed", "method")


@query(
    f"""WITH {PRICED_SQL.format(gap=GAP)} SELECT strategy, count(*) AS signals, count(*) FILTER (method = 'atr') AS atr_available, count(*) FILTER (method = 'percent') AS percent_fallback_used,
    count(*) FILTER (entry_source = 'trade_close_fallback') AS entry_from_close FROM priced GROUP BY strategy"""
)
def enrichment_counts(spark, sf_dir):
    return risk.enrichment_counts(_priced(spark, sf_dir))


_HOLD_SQL = (
    SIGNALS_SQL.format(gap=GAP)
    + f""", recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS nth FROM bars) WHERE nth <= 282
), ahead AS (SELECT symbol, trade_date, close, list({{'h': high, 'l': low}}) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING) AS nexts FROM recent
), found AS (SELECT symbol, nullif(list_position(list_transform(nexts, lambda x: x.h >= close * {1 + TARGET}::DECIMAL(10,4) OR x.l <= close * {1 - STOP:.4f}::DECIMAL(10,4)), TRUE), 0)::BIGINT AS days FROM ahead WHERE close > 0
), medians AS (SELECT symbol, count(*) AS bars, count(days) AS samples, quantile_cont(days, 0.5) AS middle FROM found GROUP BY symbol
), empirical AS (SELECT symbol, samples, CASE WHEN bars >= 10 AND samples >= 8 THEN greatest(1, least(30, ceil(middle)::BIGINT)) END AS days FROM medians)"""
)


@query(f"WITH {_HOLD_SQL} SELECT symbol, samples, days FROM empirical")
def hold_days_empirical(spark, sf_dir):
    return hold.empirical_hold(bars(spark, sf_dir, named=False), TARGET, STOP).withColumn("symbol", symbol_of("symbol"))


@query(
    f"""WITH {_HOLD_SQL} SELECT s.trade_date, s.symbol, s.strategy,
    coalesce(CASE WHEN e.days > 3 THEN e.days END, CASE WHEN f.atr_14 > 0 THEN greatest(1, least(30, ceil(f.atr_14 * 3.0::DOUBLE / greatest(0.000001::DOUBLE, f.atr_14 * 1.0::DOUBLE))::BIGINT)) END,
      CASE WHEN s.signal_score IS NOT NULL THEN greatest(1, least(30, round_even(7.0::DOUBLE * (1 - least(0.6::DOUBLE, abs(s.signal_score) / 10)), 0)::BIGINT)) END, 7) AS hold_days,
    CASE WHEN e.days > 3 THEN 'empirical' WHEN f.atr_14 > 0 THEN 'atr' WHEN s.signal_score IS NOT NULL THEN 'score' ELSE 'fallback' END AS hold_method
    FROM signals s LEFT JOIN empirical e ON e.symbol = s.symbol LEFT JOIN features f ON f.symbol = s.symbol AND f.trade_date = s.trade_date"""
)
def hold_days_cascade(spark, sf_dir):
    f = features_once(spark, sf_dir, *SIGNALLED, "high", "low")
    known = hold.empirical_hold(f, TARGET, STOP).withColumn("days", F.when(F.col("days") > 3, F.col("days")))  # some symbols fall through to the other ways
    return hold.hold_cascade(signals.all_signals(f, gap=GAP, keep=("atr_14",)), known).select("trade_date", "symbol", "strategy", "hold_days", "hold_method")


def _labels(spark, sf_dir) -> DataFrame:
    f = labels.with_bar(features(spark, sf_dir))
    return labels.outcomes(doubles(risk.priced(f, labels.BAR, gap=GAP), "entry_price"))


@query(f"WITH {LABELS_SQL.format(gap=GAP)} SELECT trade_date, symbol, strategy, side, entry_used, label, exit_price, exit_reason, ambiguous, realized_return FROM labels")
def labels_intraday(spark, sf_dir):
    return _labels(spark, sf_dir).select("trade_date", "symbol", "strategy", "side", "entry_used", "label", "exit_price", "exit_reason", "ambiguous", "realized_return")


@query(
    f"""WITH {LABELS_SQL.format(gap=GAP)} SELECT strategy, count(*) AS signals, count(*) FILTER (label = 'win') AS win, count(*) FILTER (label = 'loss') AS loss, count(*) FILTER (label = 'neutral') AS neutral,
    sum(ambiguous)::BIGINT AS ambiguous FROM labels GROUP BY strategy"""
)
def label_tallies(spark, sf_dir):
    return labels.tallies(_labels(spark, sf_dir))


@query(f"WITH {SIGNALS_SQL.format(gap=GAP)} SELECT DISTINCT trade_date FROM bars WHERE trade_date NOT IN (SELECT trade_date FROM signals WHERE entry_model = 'open')")
def unprocessed_dates(spark, sf_dir):
    f = features(spark, sf_dir)
    return labels.unprocessed(f, signals.gap_signals(f, GAP))


# liquidity


@query(f"WITH {METRICS_SQL} SELECT * EXCLUDE (avg_20d_val) FROM metrics")
def liquidity_metrics(spark, sf_dir):
    return liquidity.liquidity_metrics(bars(spark, sf_dir, named=False)).withColumn("symbol", symbol_of("symbol"))


_GATE_SQL = f"""WITH {METRICS_SQL}, gates AS (SELECT *, coalesce(avg_20d_val, 0) >= 30000 AND coalesce(avg_20d_vol, 0) >= 20 AND trades >= 1 AND close >= 20 AS hard_pass,
  coalesce(turnover_rank_pct >= quantile_cont(turnover_rank_pct, 0.7) OVER (PARTITION BY trade_date), FALSE) AS pct_pass FROM metrics)"""
_FLOORS = {"avg_20d_val": 30000.0, "avg_20d_vol": 20.0, "trades": 1.0, "close": 20.0}


@query(f"{_GATE_SQL} SELECT symbol, trade_date, hard_pass, pct_pass, hard_pass AND pct_pass AS liquidity_pass FROM gates")
def liquidity_gate(spark, sf_dir):
    df = liquidity.with_gates(liquidity.liquidity_metrics(bars(spark, sf_dir), with_avg_value=True), floors=_FLOORS)
    return df.select("symbol", "trade_date", "hard_pass", "pct_pass", "liquidity_pass")


@query(f"{_GATE_SQL} SELECT symbol, trade_date, net_trdval FROM gates WHERE hard_pass AND pct_pass")
def liquidity_enforced(spark, sf_dir):
    return liquidity.gated(liquidity.liquidity_metrics(bars(spark, sf_dir), with_avg_value=True), "enforce", floors=_FLOORS).select("symbol", "trade_date", "net_trdval")


_SCORE_SQL = (
    METRICS_SQL
    + ", "
    + SIGNALS_SQL.format(gap=GAP)[len(FEATURES_SQL) + 2 :]
    + """, parts AS (
  SELECT s.trade_date, s.symbol, s.strategy, abs(coalesce(s.signal_score, 0)) AS size, coalesce(m.net_trdval, 0) AS val, coalesce(m.avg_20d_vol, 0) AS vol FROM signals s LEFT JOIN metrics m ON m.symbol = s.symbol AND m.trade_date = s.trade_date
), scored AS (
  SELECT trade_date, symbol, strategy, CASE WHEN max(size) OVER d > 0 THEN size / max(size) OVER d ELSE 0 END * 0.6::DOUBLE + CASE WHEN max(val) OVER d > 0 THEN val / max(val) OVER d ELSE 0 END * 0.3::DOUBLE
    + CASE WHEN max(vol) OVER d > 0 THEN vol / max(vol) OVER d ELSE 0 END * 0.1::DOUBLE AS combined_score FROM parts WINDOW d AS (PARTITION BY trade_date)
)"""
)


def _scored(spark, sf_dir) -> DataFrame:
    f = liquidity.with_figures(features(spark, sf_dir))
    return liquidity.scored(signals.all_signals(f, gap=GAP, keep=("value_of", "volume_of", "fno_flag"))).select("trade_date", "symbol", "strategy", "combined_score")


@query(f"WITH {_SCORE_SQL} SELECT * FROM scored")
def combined_score(spark, sf_dir):
    return _scored(spark, sf_dir)


@query(f"WITH {_SCORE_SQL} SELECT trade_date, symbol, strategy, combined_score FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY combined_score DESC, symbol, strategy) AS nth FROM scored) WHERE nth = 1")
def daily_top_signal(spark, sf_dir):
    nth = F.row_number().over(Window.partitionBy("trade_date").orderBy(F.desc("combined_score"), "symbol", "strategy"))
    return _scored(spark, sf_dir).withColumn("nth", nth).where("nth = 1").drop("nth")


@query(f"WITH {BARS_SQL} SELECT trade_date, count(*) AS universe, round(greatest(0.05::DOUBLE, least(0.5::DOUBLE, 5::DOUBLE / count(*))), 2) AS keep FROM bars GROUP BY trade_date")
def suggested_percentile(spark, sf_dir):
    df = bars(spark, sf_dir).groupBy("trade_date").agg(F.count("*").alias("universe"))
    return df.withColumn("keep", liquidity.suggested_keep(F.col("universe"), F.lit(5.0)))


# sessions


@query(
    f"""WITH {VWAP_SQL}, ends AS (SELECT session, count(*) AS candles, arg_min(open, ts) AS o, arg_max(close, ts) AS c, max(high) AS h, min(low) AS l, count(*) FILTER (crossed) AS x, count(*) FILTER (gap > 0) AS up, count(*) FILTER (gap < 0) AS down FROM crosses GROUP BY session)
    SELECT session, candles, (h - l)::DOUBLE AS total_range, (c - o)::DOUBLE AS net_move, CASE WHEN h = l THEN 0 ELSE abs(c - o)::DOUBLE / (h - l)::DOUBLE END AS trend_strength,
    CASE WHEN h = l THEN 0 WHEN c >= o THEN (h - c)::DOUBLE / (h - l)::DOUBLE ELSE (c - l)::DOUBLE / (h - l)::DOUBLE END AS pullback_depth, x AS vwap_cross_count, CASE WHEN c >= o THEN up ELSE down END::DOUBLE / candles AS vwap_hold_percentage FROM ends"""
)
def session_summary(spark, sf_dir):
    return sessions.session_summary(candles(spark, sf_dir))


_BY_SYMBOL = """candles AS (
  SELECT event_type AS symbol, time_bucket(INTERVAL 5 MINUTE, ts)::DATE AS session, time_bucket(INTERVAL 5 MINUTE, ts) AS ts,
    arg_min(value::DECIMAL(18,4), row(ts, event_id)) AS open, max(value::DECIMAL(18,4)) AS high, min(value::DECIMAL(18,4)) AS low, arg_max(value::DECIMAL(18,4), row(ts, event_id)) AS close, count(*) AS volume
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2, 3),
days AS (SELECT symbol, session, count(*) AS candles, arg_min(open, ts) AS o, arg_max(close, ts) AS c, max(high) AS h, min(low) AS l FROM candles GROUP BY 1, 2)"""


def _candles_by_symbol(spark, sf_dir):
    """5-minute candles of each event type, which stands for an instrument."""
    rows = table(spark, sf_dir, "events").select("ts", "event_id", F.col("event_type").alias("symbol"), F.col("value").cast("decimal(18,4)").alias("price"))
    return candles_of(rows, ("symbol",))


@query(f"WITH {_BY_SYMBOL} SELECT symbol, session, candles, (h - l)::DOUBLE AS total_range, (c - o)::DOUBLE AS net_move FROM days")
def session_summary_by_symbol(spark, sf_dir):
    return sessions.session_summary(_candles_by_symbol(spark, sf_dir)).select("symbol", "session", "candles", "total_range", "net_move")


@query(f"WITH {_BY_SYMBOL}, chained AS (SELECT *, lag(c) OVER (PARTITION BY symbol ORDER BY session) AS before FROM days) SELECT symbol, session, (o - before)::DOUBLE / nullif(before, 0)::DOUBLE * 100 AS gap_pct FROM chained")
def session_gaps_by_symbol(spark, sf_dir):
    return sessions.structure(_candles_by_symbol(spark, sf_dir)).select("symbol", "session", "gap_pct")


@query(f"WITH {VWAP_SQL} SELECT session, ts, vwap_equal FROM vwaps")
def vwap_equal_weight(spark, sf_dir):
    return sessions.with_vwap(candles(spark, sf_dir)).select("session", "ts", "vwap_equal")


@query(f"WITH {VWAP_SQL} SELECT session, ts, vwap_volume FROM vwaps")
def vwap_volume(spark, sf_dir):
    return sessions.with_vwap(candles(spark, sf_dir)).select("session", "ts", "vwap_volume")


@query(f"WITH {VWAP_SQL} SELECT session, ts, crossed FROM crosses")
def vwap_crosses(spark, sf_dir):
    return sessions.with_crosses(sessions.with_vwap(candles(spark, sf_dir))).select("session", "ts", "crossed")


@query(
    f"""WITH {VWAP_SQL}, steps AS (SELECT *, lag(high) OVER w AS ph, lag(low) OVER w AS pl FROM vwaps WINDOW w AS (PARTITION BY session ORDER BY ts)
    ), days AS (SELECT session, bool_and(ph IS NULL OR high > ph) AND bool_and(pl IS NULL OR low > pl) AS up, bool_and(ph IS NULL OR high < ph) AND bool_and(pl IS NULL OR low < pl) AS down,
      arg_min(open, ts) AS o, arg_max(close, ts) AS c, arg_max(vwap_volume, ts) AS v, max(high) AS h, min(low) AS l FROM steps GROUP BY session
    ), chained AS (SELECT *, lag(c) OVER (ORDER BY session) AS before FROM days)
    SELECT session, CASE WHEN up THEN 'LONG_VALID' WHEN down THEN 'SHORT_VALID' ELSE 'INVALID' END AS structure,
      CASE WHEN before IS NULL THEN NULL WHEN o > before THEN CASE WHEN l >= before THEN 'YES' ELSE 'NO' END WHEN o < before THEN CASE WHEN h <= before THEN 'YES' ELSE 'NO' END ELSE 'NO_GAP' END AS gap_hold,
      (o - before)::DOUBLE / nullif(before, 0)::DOUBLE * 100 AS gap_pct, CASE WHEN c::DOUBLE > v THEN 'ABOVE_VWAP' WHEN c::DOUBLE < v THEN 'BELOW_VWAP' ELSE 'AT_VWAP' END AS price_vs_vwap FROM chained"""
)
def structure_flags(spark, sf_dir):
    return sessions.structure(candles(spark, sf_dir))


@query("SELECT event_id, date_trunc('second', ts + INTERVAL 330 MINUTE) AS ts, value AS open, value AS high, value AS low, value AS close, 1.0::DOUBLE AS volume, TRUE AS valid FROM events")
def candle_normalised(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    form = lambda c: F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 2 == 0, form(F.col("ts"))).otherwise(F.concat(form(F.col("ts") + F.make_dt_interval(hours=F.lit(2))), F.lit("+02:00")))  # without a zone, and two hours ahead of UTC
    flat = rows.select("event_id", text.alias("timestamp"), *[F.col("value").cast("string").alias(c) for c in OHLC], F.lit("1").alias("volume"))
    return sessions.normal_candles(flat, keep=("event_id",)).select("event_id", "ts", *OHLC, "volume", "valid")


@query(
    f"""WITH {CANDLES_SQL}, late AS (SELECT ts, max(value::DECIMAL(18,4)) AS high, min(value::DECIMAL(18,4)) AS low FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS ts, value FROM events WHERE event_type = 'error') GROUP BY ts)
    SELECT c.ts, CASE WHEN c.volume > 1 THEN c.high ELSE coalesce(l.high, c.high) END::DOUBLE AS high, CASE WHEN c.volume > 1 THEN c.low ELSE l.low END::DOUBLE AS low FROM candles c LEFT JOIN late l ON l.ts = c.ts"""
)
def gap_patch(spark, sf_dir):
    """Candles of one tick have lost their low, and only they are patched; patches are stamped 40 seconds late."""
    errors = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.window("ts", "5 minutes")["start"].alias("ts"), F.col("value").cast("decimal(18,4)").alias("price"))
    patch = errors.groupBy("ts").agg(F.max("price").alias("high"), F.min("price").alias("low")).withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 SECONDS"))
    bulk = candles(spark, sf_dir).select("ts", "high", F.when(F.col("volume") > 1, F.col("low")).alias("low"))
    return doubles(sessions.patched(bulk, patch, within=60), "high", "low").select("ts", "high", "low")


@query(f"WITH {OUTCOMES_SQL} SELECT symbol, trade_date, up_pct, down_pct, range_pct, outcome FROM outcomes")
def stock_outcome(spark, sf_dir):
    return sessions.stock_outcome(bars(spark, sf_dir))


# selection quality


def classified(spark, sf_dir) -> DataFrame:
    rows = bars(spark, sf_dir)
    chosen = F.row_number().over(Window.partitionBy("trade_date").orderBy(F.desc("net_trdval"), "symbol")) <= 5
    return selection.classes(rows.select("trade_date", "symbol", chosen.alias("selected")), sessions.stock_outcome(rows.where("high > low")))


@query(f"WITH {SELECTION_SQL} SELECT trade_date, symbol, selected, outcome, classification FROM classified")
def conversion_classes(spark, sf_dir):
    return classified(spark, sf_dir)


@query(f"WITH {SELECTION_SQL} SELECT trade_date, symbol, 'STOCK_DATA_MISSING' AS issue_type FROM classified WHERE outcome IS NULL")
def selection_data_gaps(spark, sf_dir):
    return selection.data_gaps(classified(spark, sf_dir))


@query(f"WITH {SELECTION_SQL} SELECT * FROM daily")
def conversion_summary(spark, sf_dir):
    return selection.summary(classified(spark, sf_dir))


@query(
    f"""WITH {SELECTION_SQL}, t AS (SELECT sum(candidate_count)::BIGINT AS total_candidates, sum(selected_count)::BIGINT AS total_selected, sum(good_selection)::BIGINT AS total_success, sum(bad_selection)::BIGINT AS total_failure, sum(missed_opportunity)::BIGINT AS total_missed_opportunities FROM daily)
    SELECT *, total_success::DOUBLE / total_selected AS conversion_rate, total_failure::DOUBLE / total_selected AS failure_rate, total_missed_opportunities::DOUBLE / total_candidates AS missed_opportunity_rate FROM t"""
)
def conversion_totals(spark, sf_dir):
    return selection.totals(selection.summary(classified(spark, sf_dir)))


_RULES_SQL = (
    SELECTION_SQL
    + """, rules AS (
  SELECT trade_date, 'conversion_rate' AS rule_name, conversion_rate AS current_value, 0.4::DOUBLE AS suggested_value, 'conversion_rate below threshold' AS support_metric, 0.4::DOUBLE - conversion_rate AS impact, 0.7::DOUBLE AS confidence, CASE WHEN conversion_rate < 0.3::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END AS priority FROM daily WHERE conversion_rate < 0.4::DOUBLE
  UNION ALL SELECT trade_date, 'failure_rate', failure_rate, 0.5::DOUBLE, 'failure_rate above threshold', failure_rate - 0.5::DOUBLE, 0.6::DOUBLE, CASE WHEN failure_rate > 0.6::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END FROM daily WHERE failure_rate > 0.5::DOUBLE
  UNION ALL SELECT trade_date, 'missed_opportunity_rate', missed_opportunity_rate, 0.3::DOUBLE, 'missed opportunities too high', missed_opportunity_rate - 0.3::DOUBLE, 0.65::DOUBLE, CASE WHEN missed_opportunity_rate > 0.5::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END FROM daily WHERE missed_opportunity_rate > 0.3::DOUBLE)"""
)


@query(f"WITH {_RULES_SQL} SELECT * FROM rules")
def selection_suggestions(spark, sf_dir):
    return selection.suggestions(selection.summary(classified(spark, sf_dir)))


_S = selection.SENTENCES


@query(
    f"""WITH {_RULES_SQL}, named AS (SELECT d.trade_date, CASE WHEN conversion_rate < 0.4::DOUBLE THEN 'LOW_CONVERSION' ELSE 'GOOD_CONVERSION' END AS conversion_rate_label, CASE WHEN failure_rate > 0.5::DOUBLE THEN 'HIGH_FAILURE' ELSE 'CONTROLLED_FAILURE' END AS failure_rate_label,
    CASE WHEN missed_opportunity_rate > 0.3::DOUBLE THEN 'HIGH_MISSED' ELSE 'LOW_MISSED' END AS missed_opportunity_rate_label, (SELECT count(*) FROM rules r WHERE r.trade_date = d.trade_date) AS n FROM daily d)
    SELECT trade_date, conversion_rate_label, failure_rate_label, missed_opportunity_rate_label, concat_ws(' ', CASE conversion_rate_label WHEN 'LOW_CONVERSION' THEN '{_S["LOW_CONVERSION"]}' ELSE '{_S["GOOD_CONVERSION"]}' END,
    CASE failure_rate_label WHEN 'HIGH_FAILURE' THEN '{_S["HIGH_FAILURE"]}' ELSE '{_S["CONTROLLED_FAILURE"]}' END, CASE missed_opportunity_rate_label WHEN 'HIGH_MISSED' THEN '{_S["HIGH_MISSED"]}' ELSE '{_S["LOW_MISSED"]}' END,
    CASE WHEN n > 0 THEN n || ' improvement opportunities identified.' END) AS summary_text FROM named"""
)
def selection_summary_text(spark, sf_dir):
    return selection.summary_text(selection.summary(classified(spark, sf_dir)))


@query(
    f"""WITH {CANDLES_SQL}, counts AS (SELECT session AS trade_date, count(*) AS candles FROM candles GROUP BY session), kinds AS (SELECT ts::DATE AS d, event_type, count(*) AS n, max(value) AS top FROM events GROUP BY 1, 2)
    SELECT trade_date, candles, CASE WHEN s3 AND candles >= 75 THEN CASE WHEN s1 AND s2 THEN 'COMPLETE' ELSE 'PARTIAL' END ELSE 'SKIPPED' END AS validation, CASE WHEN s3 AND candles >= 75 AND s1 AND s2 THEN 'COMPLETED' ELSE 'PARTIAL' END AS job_status
    FROM (SELECT *, EXISTS (FROM kinds WHERE d = trade_date AND event_type = 'error' AND top > 90) AS s1, EXISTS (FROM kinds WHERE d = trade_date AND event_type = 'click') AS s2, EXISTS (FROM kinds WHERE d = trade_date AND event_type = 'purchase') AS s3 FROM counts)"""
)
def session_validation(spark, sf_dir):
    counts = candles(spark, sf_dir).groupBy(F.col("session").alias("trade_date")).agg(F.count("*").alias("candles"))
    kinds = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("trade_date"), "event_type").agg(F.max("value").alias("top"))
    step = lambda kind, more="true": kinds.where((F.col("event_type") == kind) & F.expr(more))
    return selection.validation(counts, step("error", "top > 90"), step("click"), step("purchase"), counts)


# candidates and names

_NAME_SQL = "upper(trim(p_name || ' (' || p_brand || ') Pvt. Ltd. India-' || p_type))"
_KEY_SQL = _NAME_SQL
for _pattern, _with in ((r"\([^)]*\)", " "), (r"[.,''\"/\\&\-–]", " ")):
    _KEY_SQL = f"regexp_replace({_KEY_SQL}, '{_pattern}', '{_with}', 'g')"
for _ending in names.ENDINGS:
    _KEY_SQL = f"replace({_KEY_SQL}, '{_ending}', ' ')"
_KEY_SQL = rf"trim(regexp_replace({_KEY_SQL}, '\s+', ' ', 'g'))"
_LIGHT_SQL = rf"trim(regexp_replace(regexp_replace({_NAME_SQL}, '\([^)]*\)', ' ', 'g'), '\s+', ' ', 'g'))"


def _securities(spark, sf_dir) -> DataFrame:
    text = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") Pvt. Ltd. India-"), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("security"), F.concat(F.lit("P"), F.col("p_partkey")).alias("symbol"), F.col("p_partkey").alias("row_seq"), "p_retailprice", "p_size")


@query(f"SELECT p_partkey, {_KEY_SQL} AS name_key, {_LIGHT_SQL} AS light_key FROM part")
def name_normalised(spark, sf_dir):
    return _securities(spark, sf_dir).select("p_partkey", names.name_key(F.col("security")).alias("name_key"), names.light_key(F.col("security")).alias("light_key"))


@query("SELECT s_suppkey, s_acctbal::DECIMAL(12,2)::DOUBLE AS number FROM supplier")
def number_coerced(spark, sf_dir):
    plain = F.col("s_acctbal").cast("decimal(12,2)").cast("string")
    text = F.concat(F.lit(" "), F.substring(plain, 1, 2), F.lit(","), plain.substr(F.lit(3), F.length(plain)), F.lit("% "))
    return table(spark, sf_dir, "supplier").select("s_suppkey", coerce.number_text(text).alias("number"))


@query(f"SELECT p_partkey, min('P' || p_partkey) OVER () IS NOT NULL AS known, first_value('P' || p_partkey) OVER (PARTITION BY {_KEY_SQL} ORDER BY p_partkey) AS symbol FROM part")
def name_to_symbol(spark, sf_dir):
    rows = _securities(spark, sf_dir)
    return candidates.mapped(rows.drop("symbol"), rows).select("p_partkey", F.lit(True).alias("known"), "symbol")


_PARTS_SQL = f"""{FEATURES_SQL}, moved AS (SELECT symbol, trade_date, close, prev_close, net_trdval, high, low, trades, (close - prev_close)::DOUBLE / nullif(prev_close, 0)::DOUBLE * 100 AS pct FROM features
), movers AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY abs(pct) DESC NULLS LAST, symbol) AS nth FROM moved) WHERE abs(pct) >= 2000 OR nth <= 5
), leaders AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY net_trdval DESC, trades DESC, symbol) AS nth FROM moved) WHERE nth <= 3
), circuit AS (SELECT * FROM moved WHERE high > low
), parts AS (
  SELECT trade_date, symbol, 'circuit' AS reason, NULL::DOUBLE AS pct, NULL::DOUBLE AS prev_close, NULL::DOUBLE AS last_price, NULL::DOUBLE AS turnover, CASE WHEN pct > 0 THEN 'H' ELSE 'L' END AS status FROM circuit
  UNION ALL SELECT trade_date, symbol, 'gainer_loser', pct, prev_close::DOUBLE, close::DOUBLE, NULL, NULL FROM movers
  UNION ALL SELECT trade_date, symbol, 'top_turnover', NULL, NULL, NULL, net_trdval::DOUBLE, NULL FROM leaders)"""


@query(
    f"""WITH {_PARTS_SQL} SELECT trade_date, symbol, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reason_set, min(reason) AS primary_reason, max(pct) AS pct, max(prev_close) AS prev_close, max(last_price) AS last_price, max(turnover) AS turnover, max(status) AS status
    FROM parts GROUP BY trade_date, symbol"""
)
def candidate_merge(spark, sf_dir):
    moved = features(spark, sf_dir).withColumn("pct", coerce.ratio(F.col("close") - F.col("prev_close"), F.col("prev_close")) * 100)
    rows = moved.withColumn("security", F.col("symbol")).withColumn("row_seq", F.substring("symbol", 2, 18).cast("long"))
    # ties go by symbol, in the order of text
    rows = rows.withColumn("row_seq", F.row_number().over(Window.partitionBy("trade_date").orderBy("symbol")).cast("long"))
    none = lambda kind: F.lit(None).cast(kind)
    part = lambda df, reason, pct, before, last, turnover, status: df.select("trade_date", "symbol", F.lit(reason).alias("reason"), "row_seq", pct.alias("pct"), before.alias("prev_close"), last.alias("last_price"), turnover.alias("turnover"), status.alias("status"))
    d = F.col
    hitters = part(rows.where("high > low"), "circuit", none("double"), none("double"), none("double"), none("double"), F.when(d("pct") > 0, "H").otherwise("L"))
    movers = part(candidates.movers(rows, 2000.0, 5), "gainer_loser", d("pct"), d("prev_close").cast("double"), d("close").cast("double"), none("double"), none("string"))
    leaders = candidates.turnover_leaders(rows.withColumn("value", d("net_trdval")).withColumn("qty", d("trades")), 3)
    leaders = part(leaders, "top_turnover", none("double"), none("double"), none("double"), d("net_trdval").cast("double"), none("string"))
    return candidates.merged(hitters.unionByName(movers).unionByName(leaders))


def _suppliers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.concat(F.lit("SUP"), F.col("s_suppkey")).alias("symbol"), F.col("s_name").alias("security"), F.col("s_suppkey").alias("row_seq"), F.col("s_acctbal").alias("close"))


@query(
    """WITH s AS (SELECT *, 'SUP' || s_suppkey AS sym, CASE WHEN s_nationkey < 15 THEN 'SUP' || s_suppkey ELSE s_name END AS asked FROM supplier)
    SELECT asked AS symbol, CASE WHEN s_nationkey < 15 AND s_acctbal > 0 THEN s_name WHEN s_nationkey < 15 AND s_nationkey >= 5 THEN sym WHEN s_nationkey >= 15 AND s_acctbal > 0 THEN s_name END AS security,
    CASE WHEN s_nationkey < 15 AND s_acctbal > 0 THEN s_acctbal WHEN s_nationkey < 15 AND s_nationkey >= 5 THEN s_acctbal WHEN s_nationkey >= 15 AND s_acctbal > 0 THEN s_acctbal END AS close,
    CASE WHEN s_nationkey < 15 AND s_acctbal > 0 THEN 'pd' WHEN s_nationkey < 15 AND s_nationkey >= 5 THEN 'pr_by_symbol' WHEN s_nationkey >= 15 AND s_acctbal > 0 THEN 'pd_by_name' ELSE 'miss' END AS source FROM s"""
)
def enrichment_cascade(spark, sf_dir):
    rows = _suppliers(spark, sf_dir)
    asked = rows.select(F.when(F.col("s_nationkey") < 15, F.col("symbol")).otherwise(F.col("security")).alias("symbol"))
    prices = rows.where("s_nationkey >= 5 and s_nationkey < 15 and s_acctbal <= 0").withColumn("security", F.col("symbol"))
    return candidates.enriched(asked, rows.where("s_acctbal > 0"), prices)


@query("SELECT DISTINCT 'S' || l_suppkey AS symbol FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def instrument_semi(spark, sf_dir):
    master = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.concat(F.lit(" s"), F.col("s_suppkey")).alias("symbol"))
    return candidates.in_master(table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol")).distinct(), master)


@query("SELECT 'S' || s_suppkey AS symbol FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)")
def instrument_missing(spark, sf_dir):
    held = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 49").select(F.concat(F.lit("s"), F.col("l_suppkey")).alias("symbol"))
    return candidates.missing_from(table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("symbol")), held)


# instruments


@query(
    """WITH new AS (SELECT s_name AS symbol, CASE WHEN s_acctbal > 5000 THEN 'N' ELSE 'B' END AS market_type, CASE WHEN s_nationkey < 5 THEN 'BE' ELSE 'EQ' END AS series, n_name AS notes, s_acctbal FROM supplier JOIN nation ON n_nationkey = s_nationkey)
    SELECT symbol, CASE WHEN s_acctbal <= 0 THEN 'inserted' WHEN market_type = 'N' AND series = 'EQ' THEN 'no_change' ELSE 'updated' END AS action,
    CASE WHEN s_acctbal <= 0 THEN '' ELSE concat_ws(';', CASE WHEN market_type <> 'N' THEN 'market_type:N>' || market_type END, CASE WHEN series <> 'EQ' THEN 'series:EQ>' || series END) END AS diff FROM new"""
)
def change_diff(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    new = rows.select(F.col("s_name").alias("symbol"), F.when(F.col("s_acctbal") > 5000, "N").otherwise("B").alias("market_type"), F.when(F.col("s_nationkey") < 5, "BE").otherwise("EQ").alias("series"), F.col("n_name").alias("notes"))
    old = rows.where("s_acctbal > 0").select(F.col("s_name").alias("symbol"), F.lit("N").alias("market_type"), F.lit("EQ").alias("series"), F.col("n_name").alias("notes"))
    return instruments.changes(new, old, ("series", "market_type", "notes"))


@query("SELECT o_custkey, o_orderkey, o_orderdate::DATE AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS nth FROM orders) WHERE nth = 1")
def keep_latest(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return instruments.keep_latest(df, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders) WHERE nth = 1")
def keep_first(spark, sf_dir):
    return instruments.keep_first(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey").drop("o_orderdate")


def _staging(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") > -900, F.col("c_name")).otherwise(" ").alias("Symbol"),
        F.when(F.col("c_nationkey") < 12, " eq ").otherwise("BE").alias("SERIES"),
        F.substring("c_mktsegment", 1, 1).alias("MKT"),
        F.col("c_nationkey").alias("NATION"),
        F.lit("pd.csv").alias("source_file"),
        F.col("c_custkey").alias("row_seq"),
    )
    etfs = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_name").alias("symbol"))
    return instruments.staged_rows(rows, ("symbol_x", "SYMBOL"), ("series",), ("market", "mkt"), etfs).withColumn("market_type_raw", F.when(F.col("market_type_raw") == "B", "N").otherwise(F.col("market_type_raw")))


@query(
    """SELECT c_name AS symbol_raw, CASE WHEN c_nationkey < 12 THEN 'eq' ELSE 'BE' END AS series_raw, '{"NATION":' || c_nationkey || '}' AS other_raw, c_acctbal > 9000 AS is_etf,
    c_acctbal <= 9000 AND c_nationkey < 12 AND c_mktsegment LIKE 'B%' AS include_in_bhav, TRUE AS is_valid FROM customer WHERE c_acctbal > -900"""
)
def staging_validated(spark, sf_dir):
    return instruments.validated(_staging(spark, sf_dir)).select("symbol_raw", "series_raw", "other_raw", "is_etf", "include_in_bhav", "is_valid")


@query("SELECT c_name AS symbol_raw FROM customer WHERE c_acctbal > -900 AND c_acctbal <= 9000 AND c_nationkey < 12 AND c_mktsegment LIKE 'B%'")
def staging_eligible(spark, sf_dir):
    return instruments.eligible(_staging(spark, sf_dir)).select("symbol_raw")


@query("SELECT o_orderkey AS token FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderstatus = 'F'")
def index_futures(spark, sf_dir):
    urgent = F.col("o_orderpriority").startswith("1")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("token"),
        F.when(urgent, "BANKNIFTY").otherwise("ACME").alias("name"),
        F.concat(F.lit("X"), F.col("o_custkey")).alias("tradingsymbol"),
        F.to_date("o_orderdate").alias("expiry"),
        F.lit("nfo").alias("exchange"),
        F.lit("").alias("segment"),
        F.when(F.col("o_orderstatus") == "F", "fut").otherwise("CE").alias("instrument_type"),
    )
    return instruments.index_futures(rows).select("token")


@query(
    f"""WITH {BARS_SQL}, dates AS (SELECT DISTINCT trade_date FROM bars), firsts AS (SELECT o_orderdate::DATE AS expiry, min(o_orderkey) AS token, arg_min('C' || o_custkey, o_orderkey) AS tradingsymbol FROM orders GROUP BY 1)
    SELECT d.trade_date, f.expiry, f.token, f.tradingsymbol FROM dates d ASOF JOIN firsts f ON d.trade_date <= f.expiry"""
)
def nearest_contract(spark, sf_dir):
    contracts = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("expiry"), F.col("o_orderkey").alias("token"), F.concat(F.lit("C"), F.col("o_custkey")).alias("tradingsymbol"))
    return instruments.nearest_contract(bars(spark, sf_dir).select("trade_date"), contracts)


# stores


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, close::DOUBLE AS close FROM bars WHERE close >= 50000")
def insert_if_absent(spark, sf_dir):
    rows = doubles(bars(spark, sf_dir), "close").select("symbol", "trade_date", "close")
    return store.absent(rows.where("close < 50000"), rows, ["symbol", "trade_date"])


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, CASE WHEN trades > 1 THEN open ELSE close END::DOUBLE AS score, CASE WHEN trades > 1 AND close > open THEN high ELSE low END::DOUBLE AS stop FROM bars")
def upsert_coalesce(spark, sf_dir):
    rows = bars(spark, sf_dir)
    old = rows.select("symbol", "trade_date", F.col("close").cast("double").alias("score"), F.col("low").cast("double").alias("stop"))
    new = rows.where("trades > 1").select("symbol", "trade_date", F.col("open").cast("double").alias("score"), F.when(F.col("close") > F.col("open"), F.col("high").cast("double")).alias("stop"))
    new = new.withColumn("version", F.lit(2)).unionByName(new.withColumns({"version": F.lit(1), "score": F.lit(-1.0), "stop": F.lit(-1.0)}))  # every key twice, the second one counts
    return store.coalesced(old, new, ["symbol", "trade_date"], ("stop",), ("version",))


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, CASE WHEN trades > 1 THEN open ELSE close END::DOUBLE AS price, high::DOUBLE AS high FROM bars")
def row_update(spark, sf_dir):
    rows = doubles(bars(spark, sf_dir), "open", "high", "close")
    old = rows.select("symbol", "trade_date", F.col("close").alias("price"), "high")
    new = rows.where("trades > 1").select("symbol", "trade_date", F.col("open").alias("price"), F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    new = new.withColumn("price", F.when(F.col("version") == 2, F.col("price")).otherwise(F.lit(None)))
    return store.updated(old, new, ["symbol", "trade_date"], ("price",), ("version",))


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, CASE WHEN trades > 1 THEN open ELSE close END::DOUBLE AS price FROM bars")
def upsert_replace(spark, sf_dir):
    rows = doubles(bars(spark, sf_dir), "open", "close")
    old = rows.select("symbol", "trade_date", F.col("close").alias("price"))
    new = rows.where("trades > 1").select("symbol", "trade_date", F.col("open").alias("price"), F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    new = new.withColumn("price", F.when(F.col("version") == 2, F.col("price")).otherwise(F.lit(-1.0)))  # every key twice, the second one counts
    return store.replaced(old, new, ["symbol", "trade_date"], ("version",))


# dates


@query(
    f"""WITH {BARS_SQL}, days AS (SELECT DISTINCT trade_date FROM bars), asked AS (SELECT DISTINCT o_orderdate::DATE AS asked FROM orders UNION SELECT NULL)
    SELECT asked, CASE WHEN asked IS NULL THEN (SELECT max(trade_date) FROM days) ELSE (SELECT max(trade_date) FROM days WHERE trade_date <= asked) END AS trade_date FROM asked"""
)
def trading_day_resolve(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("asked")).unionByName(spark.range(1).select(F.lit(None).cast("date").alias("asked")))
    return trading_days.resolved(asked, bars(spark, sf_dir))


_DAYS = ", ".join(f"DATE '{d}'" for d in trading_days.HOLIDAYS)


@query(
    f"""WITH days AS (SELECT o_orderkey, make_date(2026, month(o_orderdate), day(o_orderdate)) AS d FROM orders WHERE NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 29))
    SELECT o_orderkey, d AS trade_date, isodow(d) >= 6 AS is_weekend, d IN ({_DAYS}) AS is_holiday, isodow(d) < 6 AND d NOT IN ({_DAYS}) AS is_open, CASE WHEN isodow(d) >= 6 THEN d - (isodow(d) - 5)::INT ELSE d END AS last_weekday FROM days"""
)
def trading_calendar(spark, sf_dir):
    """Whether the day of each order would have been open in the year of the known holidays."""
    day = F.make_date(F.lit(2026), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    rows = table(spark, sf_dir, "orders").where("not (month(o_orderdate) = 2 and day(o_orderdate) = 29)").select("o_orderkey", day.alias("trade_date"))
    return rows.join(trading_days.marked(rows.select("trade_date").distinct()), "trade_date")


@query(f"WITH {BARS_SQL} SELECT DISTINCT trade_date FROM bars WHERE trade_date NOT IN (SELECT o_orderdate::DATE FROM orders WHERE o_orderstatus IN ('F', 'P'))")
def pending_dates(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "P", "PARTIAL").otherwise("FAILED")
    jobs = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("trade_date"), status.alias("status"))
    return trading_days.pending(bars(spark, sf_dir), jobs)


@query("SELECT o_custkey, day FROM (SELECT o_custkey, o_orderdate::DATE AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderdate::DATE) AS nth FROM orders GROUP BY 1, 2) WHERE nth = 1")
def date_mode(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.mode(F.to_date("o_orderdate"), True).alias("day"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 AND year(o_orderdate) > 1994 THEN o_orderdate::DATE WHEN o_orderkey % 5 = 4 THEN (o_orderdate + INTERVAL 100 YEAR)::DATE ELSE o_orderdate::DATE END AS day FROM orders WHERE NOT (o_orderkey % 5 = 4 AND month(o_orderdate) = 2 AND day(o_orderdate) = 29)")
def file_dates(spark, sf_dir):
    """Two-digit years up to 94 are of this century here, those beyond of the last one."""
    form = lambda f: F.date_format("o_orderdate", f)
    eight = F.when(F.col("o_orderstatus") == "F", form("'PR'yyyyMMdd'.zip'")).when(F.col("o_orderstatus") == "O", form("'PR'ddMMyyyy'.zip'")).otherwise(F.concat(form("'PR'dd"), form("MMyyyy'.csv'")))
    name = F.when(F.col("o_orderkey") % 5 == 4, form("'PR'ddMMyy'.zip'")).otherwise(eight)
    rows = table(spark, sf_dir, "orders").where(~((F.col("o_orderkey") % 5 == 4) & (F.month("o_orderdate") == 2) & (F.dayofmonth("o_orderdate") == 29)))
    return rows.select("o_orderkey", names.file_date(name, F.lit(2094)).alias("day"))


@query("""SELECT event_id, json(props)::VARCHAR AS canonical, '"' || event_type || '"' AS quoted, (props->>'$.k')::BIGINT AS k FROM events""")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", coerce.canonical_json(F.col("props")).alias("canonical"), coerce.canonical_json(F.col("event_type")).alias("quoted"), F.get_json_object("props", "$.k").cast("bigint").alias("k"))


# scans


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, close::DOUBLE AS close FROM bars WHERE trade_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND mkt_flag = 0 AND ind_sec = 'N'")
def bars_range_scan(spark, sf_dir):
    return doubles(scans.bars_between(bars(spark, sf_dir), "1995-01-01", "1996-12-31"), "close").select("symbol", "trade_date", "close")


@query(
    f"""WITH {BARS_SQL} SELECT symbol, trade_date, close::DOUBLE AS close, (lag(close) OVER (PARTITION BY symbol ORDER BY trade_date))::DOUBLE AS prev_close FROM bars
    WHERE trade_date BETWEEN DATE '1996-06-30' - 200 AND DATE '1996-06-30' AND symbol IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal > 0)"""
)
def bars_for_symbols(spark, sf_dir):
    wanted = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.concat(F.lit(" s"), F.col("s_suppkey")).alias("symbol"))
    return doubles(scans.bars_for_symbols(bars(spark, sf_dir), wanted, "1996-06-30", 100), "close", "prev_close").select("symbol", "trade_date", "close", "prev_close")


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS nth FROM bars) WHERE nth <= 292")
def latest_bars(spark, sf_dir):
    return scans.latest_bars(bars(spark, sf_dir), 292).select("symbol", "trade_date")


@query(f"WITH {SIGNALS_SQL.format(gap=GAP)} SELECT symbol, trade_date, high::DOUBLE AS high FROM bars WHERE (symbol, trade_date) IN (SELECT (symbol, trade_date) FROM gaps)")
def bars_for_pairs(spark, sf_dir):
    f = features(spark, sf_dir)
    return doubles(scans.bars_for_pairs(bars(spark, sf_dir), signals.gap_signals(f, GAP)), "high").select("symbol", "trade_date", "high")


@query(f"WITH {SIGNALS_SQL.format(gap=GAP)} SELECT DISTINCT g.symbol, g.trade_date, f.atr_14, f.rsi_14 FROM gaps g LEFT JOIN features f ON f.symbol = g.symbol AND f.trade_date = g.trade_date")
def feature_lookup(spark, sf_dir):
    f = features(spark, sf_dir)
    return scans.feature_lookup(indicators.long_features(f), signals.gap_signals(f, GAP), ("atr_14", "rsi_14"))


@query(f"WITH {BARS_SQL} SELECT trade_date FROM (SELECT DISTINCT trade_date FROM bars ORDER BY trade_date DESC LIMIT 30) UNION SELECT DISTINCT trade_date FROM bars WHERE trades > 3")
def last_dates(spark, sf_dir):
    rows = bars(spark, sf_dir)
    return scans.last_dates(rows, 30, rows.where("trades > 3"))


@query(f"WITH {OUTCOMES_SQL} SELECT coalesce(outcome, 'MISSING') AS outcome, count(*) AS n FROM outcomes GROUP BY 1")
def outcome_tallies(spark, sf_dir):
    return scans.tallied(sessions.stock_outcome(bars(spark, sf_dir)), "outcome")


@query("""SELECT s_suppkey, '{"bal":' || s_acctbal::DECIMAL(12,2)::DOUBLE || ',"name":"' || s_name || '","nation":' || s_nationkey || '}' AS extras FROM supplier""")
def extras_packed(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").cast("decimal(12,2)").alias("bal"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return rows.select("s_suppkey", scans.extras(rows, ("s_suppkey",)).alias("extras"))


@query("SELECT s_suppkey, upper(left(s_name, 1)) = 'Y' OR s_nationkey < 8 AS flagged, CASE WHEN s_nationkey < 8 THEN 1 ELSE 0 END AS mkt_flag FROM supplier")
def market_flags(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").withColumn("mkt", F.when(F.col("s_nationkey") < 8, " y ").otherwise("N"))
    return rows.select("s_suppkey", (coerce.market_flag(F.col("mkt")) == 1).alias("flagged"), coerce.market_flag(F.col("mkt")).alias("mkt_flag"))


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close FROM bars")
def columns_resolved(spark, sf_dir):
    rows = bars(spark, sf_dir).select(F.col("symbol").alias("Ticker"), F.col("trade_date").alias("DATE"), F.col("open").alias("Open_Price"), F.col("high").alias("HIGH"), F.col("low").alias("l"), F.col("close").alias("CLOSE_PRIC"))
    return doubles(scans.resolved_columns(rows), *OHLC)


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'PR' || o_custkey || '.zip' ELSE 'other.zip' END AS file, o_orderdate::DATE AS trading_date FROM orders WHERE o_orderstatus <> 'P'")
def report_match(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    day = F.date_format("o_orderdate", "dd-MMM-yyyy")
    entry = lambda name: F.array(F.struct(name.alias("file"), day.alias("tradingDate")))
    wanted = F.concat(F.lit("PR"), F.col("o_custkey"), F.lit(".zip"))
    text = F.to_json(F.struct(entry(F.lit("other.zip")).alias("CurrentDay"), F.when(F.col("o_orderstatus") == "F", entry(wanted)).alias("PreviousDay")))
    entries = scans.report_entries(rows.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), text.alias("json")))
    return scans.matching_entry(entries, F.concat(F.lit("PR"), F.col("o_custkey"), F.lit(".zip")), F.col("day"), "o_orderkey").select("o_orderkey", "file", "trading_date")


# what single steps of the reading jobs do


@query(f"""WITH {FEATURES_SQL}, means AS (SELECT symbol, trade_date, trades, CASE WHEN count(range_skip) OVER w >= 7 THEN sum(range_skip) OVER w::DOUBLE / count(range_skip) OVER w END AS atr
  FROM features WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
  before AS (SELECT *, last_value(atr IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM means)
  SELECT symbol, trade_date AS ref_date, known AS atr FROM before WHERE trades > 1""")
def atr_at_date(spark, sf_dir):
    """The ATR that is known before a date, for every bar of more than one trade."""
    asked = bars(spark, sf_dir).where("trades > 1").select("symbol", F.col("trade_date").alias("ref_date"))
    return scans.atr_at(_atr(spark, sf_dir, indicators.range_skip_null, 7), asked)


@query("SELECT event_id, '{\"a\":' || event_id || ',\"b\":\"' || event_type || '\",\"liquidity\":{\"rank\":' || event_id % 7 || '}}' AS params FROM events WHERE event_id % 3 <> 2 UNION ALL SELECT event_id, '{\"liquidity\":{\"rank\":' || event_id % 7 || '}}' FROM events WHERE event_id % 3 = 2")
def params_with_liquidity(spark, sf_dir):
    """An old liquidity is replaced, and text that is no object counts as an empty one."""
    rows = table(spark, sf_dir, "events")
    whole = F.format_string('{"b":"%s","liquidity":{"rank":-1},"a":%d}', "event_type", "event_id")
    params = F.when(F.col("event_id") % 3 == 0, whole).when(F.col("event_id") % 3 == 1, F.format_string('{"a":%d,"b":"%s"}', "event_id", "event_type")).otherwise(F.lit("[1, broken"))
    return rows.select("event_id", coerce.with_member(params, "liquidity", F.format_string('{"rank":%d}', F.col("event_id") % 7)).alias("params"))


@query("SELECT s_suppkey, CASE s_nationkey % 4 WHEN 0 THEN s_name WHEN 1 THEN s_name WHEN 2 THEN 'Firm ' || s_suppkey END AS security FROM supplier")
def security_from_fields(spark, sf_dir):
    """Named, in single quotes, by the first long text, and not at all."""
    forms = ('{"SECURITY":" %s ","N":"1"}', "{'security':'%s','N':'1'}", '{"N":"1.25","X":"Firm %d","Y":"Other %d"}', "%s")
    rows = table(spark, sf_dir, "supplier")
    text = F.when(F.col("s_nationkey") % 4 == 0, F.format_string(forms[0], "s_name")).when(F.col("s_nationkey") % 4 == 1, F.format_string(forms[1], "s_name"))
    text = text.when(F.col("s_nationkey") % 4 == 2, F.format_string(forms[2], "s_suppkey", "s_suppkey")).otherwise(F.format_string(forms[3], "s_name"))
    return rows.select("s_suppkey", coerce.security_in(coerce.object_fields(text)).alias("security"))


@query("SELECT o_orderkey, o_orderdate::DATE AS created_at FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate::DATE, o_orderkey LIMIT 50")
def staging_pending(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("validation_status"))
    return scans.staging_by_status(rows, "P", 50, "o_orderkey").select("o_orderkey", "created_at")


@query(f"WITH {SIGNALS_SQL.format(gap=GAP)} SELECT symbol, strategy FROM signals WHERE trade_date = DATE '1996-03-13'")
def signals_for_date(spark, sf_dir):
    found = signals.all_signals(features(spark, sf_dir), gap=GAP)
    return scans.signals_of(found, "1996-03-13").select("symbol", "strategy")


@query(
    """WITH days AS (SELECT DISTINCT o_orderdate::DATE AS trade_date FROM orders), controls AS (SELECT DISTINCT o_orderdate::DATE AS trade_date FROM orders WHERE o_custkey % 50 = 7 AND year(o_orderdate) >= 1993),
    stocks AS (SELECT o_orderdate::DATE AS trade_date, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), first AS (SELECT min(trade_date) AS day FROM controls)
    SELECT d.trade_date, c.trade_date IS NOT NULL AS step3_execution, CASE WHEN c.trade_date IS NULL THEN 0 ELSE coalesce(s.n, 0) END AS stock_count, CASE WHEN c.trade_date IS NULL THEN 'REJECTED' ELSE 'SELECTED' END AS status,
    CASE WHEN c.trade_date IS NULL THEN 'Missing step3_execution_control' WHEN coalesce(s.n, 0) = 0 THEN 'Valid trade_date with no STEP3 selections' ELSE 'Valid trade_date with STEP3 output' END AS reason
    FROM days d LEFT JOIN controls c USING (trade_date) LEFT JOIN stocks s USING (trade_date), first WHERE d.trade_date <= first.day"""
)
def date_resolution(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("trade_date"), "o_custkey", "o_orderstatus")
    return trading_days.resolution_log(rows, rows.where((F.col("o_custkey") % 50 == 7) & (F.year("trade_date") >= 1993)), rows.where("o_orderstatus = 'P'"))


@query(f"WITH {CANDLES_SQL} SELECT ts, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume FROM candles")
def candle_csv(spark, sf_dir):
    """Candles written as CSV files and read back."""
    rows = candles(spark, sf_dir)
    path = f"{_shared(spark)}/candle-files-{os.urandom(8).hex()}"
    store.write_csv(rows.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Datetime"), *[F.col(c).cast("string").alias(c.title()) for c in OHLC], F.format_number("volume", 0).alias("Volume"), F.lit("x").alias("Other")), path)
    return scans.candle_file(spark, path, keep=("Datetime",)).withColumn("ts", F.col("Datetime").cast("timestamp_ntz")).drop("Datetime")


# archives and streams


def _daily_archive(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A day's archive: movers, circuit hitters, turnover and the list of symbols."""
    day = f"{key[0]:%d%m%y}"
    table = lambda header, lines: "\n".join([header, *lines])
    rows = rows.sort_values("symbol")
    members = {
        "GL": table("SECURITY,PERCENT_CG,CLOSE_PRIC,PREV_CL_PR", rows["gl"]),
        "HL": table("SECURITY,NEW_STATUS", rows["hl"].dropna()),
        "TT": table("SECURITY,NET_TRDVAL,NET_TRDQTY", rows["tt"]),
        "PD": table("SYMBOL,SECURITY", rows["pd"]),
    }
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        for kind, text in members.items():
            z.writestr(f"{kind}{day}.csv", text)
    return pd.DataFrame({"path": [f"/PR{day}.zip"], "content": [made.getvalue()]})


@query(
    f"""WITH {_PARTS_SQL} SELECT trade_date, symbol, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reason_set, min(reason) AS primary_reason, max(pct) AS pct, max(prev_close) AS prev_close, max(last_price) AS last_price, max(turnover) AS turnover, max(status) AS status
    FROM parts WHERE substr(symbol, 2)::INT % 3 <> 0 GROUP BY trade_date, symbol"""
)
def candidates_from_archive(spark, sf_dir):
    """Every day's archive made in a task, and read to the candidates that the master has."""
    moved = features_once(spark, sf_dir, "high", "low", "close", "prev_close", "net_trdval", "trades").withColumn("pct", coerce.ratio(F.col("close") - F.col("prev_close"), F.col("prev_close")) * 100)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    name = F.concat(F.lit("Co. "), F.col("symbol"), F.lit(" Ltd."))
    line = lambda *parts: F.concat_ws(",", *parts)
    rows = moved.select(
        "trade_date",
        "symbol",
        line(name, text("pct"), text("close"), text("prev_close")).alias("gl"),
        F.when(F.col("high") > F.col("low"), line(name, F.when(F.col("pct") > 0, "H").otherwise("L"))).alias("hl"),
        line(name, text("net_trdval"), text("trades")).alias("tt"),
        line(F.col("symbol"), name).alias("pd"),
    )
    parts = max(spark.sparkContext.defaultParallelism, -(-moved.count() // PART_ROWS))
    rows = rows.repartition(parts, "trade_date")  # an archive a day
    files = rows.groupBy("trade_date").applyInPandas(_daily_archive, "path string, content binary").withColumn("modificationTime", F.lit("2025-10-03 18:00:00").cast("timestamp"))
    master = moved.select("symbol").distinct().where(F.substring("symbol", 2, 18).cast("int") % 3 != 0)
    members = staged(archive.member_rows(files), "members")  # read for each kind of member
    return candidates.from_archive(members, master, 2000.0, 5, 3)


def _staging_archive(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A nation's archive: a price file, in part without symbols, the list of symbols, and one of ETFs."""
    rows = rows.sort_values("s_suppkey")
    line = lambda *parts: ",".join(map(str, parts))
    members = {
        "PR031025.csv": ["SYMBOL,SECURITY,SERIES,MKT", *(line("" if k % 2 else f"SUP{k}", n, "EQ", "N") for k, n in zip(rows["s_suppkey"], rows["s_name"], strict=True))],
        "PD031025.csv": ["SYMBOL,SECURITY", *(line(f"SUP{k}", n.upper()) for k, n in zip(rows["s_suppkey"], rows["s_name"], strict=True) if k % 4 != 3)],
        "ETF031025.csv": ["SYMBOL,SECURITY", *(line(f"SUP{k}", "") for k in rows["s_suppkey"] if k % 5 == 0)],
    }
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        for name, lines in members.items():
            z.writestr(name, "\n".join(lines))
    return pd.DataFrame({"path": [f"/{key[0]}/PR031025.zip"], "content": [made.getvalue()]})


@query(
    """WITH s AS (SELECT *, s_suppkey % 2 = 0 AS has, s_suppkey % 4 <> 3 AS listed, s_suppkey % 5 = 0 AS etf, row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 2 ORDER BY s_suppkey) AS nth FROM supplier)
    SELECT s_nationkey::VARCHAR AS nation, CASE WHEN has OR listed THEN 'SUP' || s_suppkey END AS symbol_raw, '{"SECURITY":"' || s_name || '"}' AS other_raw, etf AND (has OR listed) AS is_etf, NOT has AND listed AS resolved FROM s WHERE has OR nth = 1"""
)
def staging_from_archive(spark, sf_dir):
    """Rows without a symbol are one key, as in the file itself, so that the first of them stays."""
    files = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name").groupBy("s_nationkey").applyInPandas(_staging_archive, "path string, content binary")
    rows = instruments.staged_members(archive.member_rows(files.withColumn("modificationTime", F.lit("2025-10-03 18:00:00").cast("timestamp"))))
    rows = rows.where("source_file = 'PR031025.csv'")
    return rows.select(F.regexp_extract("archive", "^/([^/]+)/", 1).alias("nation"), "symbol_raw", "other_raw", "is_etf", "resolved")


def _archive(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A ZIP archive with a member of the rows' lines, an empty line, a line that is too long and one that is too short, and one member that is no table."""
    lines = ["Security ,close_price,prev_cl_pr", "", "much,too,long,a line", *rows.sort_values("s_suppkey")["line"], "short line"]
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        z.writestr("x/GL031025.csv", "\n".join(lines))
        z.writestr("readme.txt", "no table")
    return pd.DataFrame({"path": [f"/{key[0]}/PR031025.zip"], "content": [made.getvalue()]})


@query("""SELECT s_nationkey::VARCHAR AS nation, DATE '2025-10-03' AS trade_date, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS row_seq, s_name AS security,
  (1000 + abs(s_acctbal::DECIMAL(18,2)) % 1000)::DOUBLE AS close, '{"PREV_CL_PR":"' || s_nationkey || '"}' AS extras FROM supplier
  UNION ALL SELECT s_nationkey::VARCHAR, DATE '2025-10-03', count(*), 'short line', NULL, '{}' FROM supplier GROUP BY s_nationkey""")
def archive_scan(spark, sf_dir):
    """Suppliers of each nation in an archive of their own, made in tasks, and read back through it."""
    amount = F.lpad((F.abs(F.col("s_acctbal").cast("decimal(18,2)")) % 1000).cast("decimal(5,2)").cast("string"), 6, "0")
    line = F.format_string('"%s","1,%s",%d', "s_name", amount, "s_nationkey")
    files = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", line.alias("line")).groupBy("s_nationkey").applyInPandas(_archive, "path string, content binary")
    rows = archive.member_rows(files.withColumn("modificationTime", F.lit("2025-10-03 18:00:00").cast("timestamp")), kinds=("GL",))
    df = archive.projected(rows, "GL", {"security": ("SECURITY",), "close": ("CLOSE_PRIC", "CLOSE_PRICE")}, keep=("archive",))
    return df.select(F.regexp_extract("archive", "^/([^/]+)/", 1).alias("nation"), "trade_date", "row_seq", "security", coerce.number_text(F.col("close")).alias("close"), "extras")


def _damaged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """An archive that is whole, cut short, or has a member whose bytes were changed; or a file that is no archive."""
    made = _archive(key, rows)
    content, kind = made["content"][0], int(key[0]) % 4
    at = content.index(b"Security ")
    broken = (content, content[: len(content) // 2], content[: at + 40] + bytes(b ^ 1 for b in content[at + 40 : at + 60]) + content[at + 60 :], b"no archive")
    return made.assign(content=[broken[kind]])


@query("""SELECT s_nationkey::VARCHAR AS nation, s_nationkey % 4 = 2 AS in_member, s_nationkey % 4 <> 0 AS faulty, CASE WHEN s_nationkey % 4 = 0 THEN count(*) + 1 ELSE 0 END AS table_rows FROM supplier WHERE s_nationkey % 4 <> 3 GROUP BY s_nationkey""")
def archive_faults(spark, sf_dir):
    """Damaged archives are told in a column, and the others are read."""
    files = table(spark, sf_dir, "supplier").withColumn("line", F.lit("a,1,2")).select("s_nationkey", "s_suppkey", "line").groupBy("s_nationkey").applyInPandas(_damaged, "path string, content binary")
    rows = archive.member_rows(files.withColumn("modificationTime", F.lit("2025-10-03 18:00:00").cast("timestamp")))
    rows = rows.groupBy(F.regexp_extract("archive", "^/([^/]+)/", 1).alias("nation")).agg(F.bool_or(F.col("fault").isNotNull() & F.col("member").isNotNull()).alias("in_member"), F.bool_or(F.col("fault").isNotNull()).alias("faulty"), F.count("fields").alias("table_rows"))
    return rows


def _shared(spark: SparkSession) -> str:
    return shared_dir(spark)


@query(f"WITH {CANDLES_SQL}, newest AS (SELECT max(ts) AS last FROM events) SELECT ts, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume FROM candles, newest WHERE ts + INTERVAL 5 MINUTE <= last - INTERVAL 10 MINUTE")
def candle_stream(spark, sf_dir):
    """The stream run until it has caught up; windows that may still get late ticks aren't there yet."""
    batch = table(spark, sf_dir, "events")
    path = f"{_shared(spark)}/candles-{os.urandom(8).hex()}"
    ticks = spark.readStream.schema(batch.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events*.parquet")
    streams.catch_up(streams.candle_stream(ticks), f"{path}/out", f"{path}/state").awaitTermination()
    schema = "ts timestamp, open decimal(18,4), high decimal(18,4), low decimal(18,4), close decimal(18,4), volume long"
    return doubles(spark.read.schema(schema).parquet(f"{path}/out"), *OHLC).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
