"""Liquidity of symbols within their day, gates on it, and the combined score of signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.coerce import ratio_or_zero
from quotemill.operators import ranks
from quotemill.operators.indicators import mean_of_days, series
from quotemill.sources.table_io import staged

#: Floors of the hard gate: mean value, mean volume, trades, close.
FLOORS = {"avg_20d_val": 200_000.0, "avg_20d_vol": 20_000.0, "trades": 50.0, "close": 20.0}
KEEP = 0.30
#: Below it no two values of up to four places are one double, so that doubles rank them; beyond it decimals do, among equal doubles.
EXACT_BELOW = 2**53 // 20_000


def liquidity_metrics(bars: DataFrame, with_avg_value: bool = False) -> DataFrame:
    """symbol, trade_date, net_trdval, net_trdqty, trades, close, avg_20d_vol, turnover_rank_pct, turnover_norm, vol_norm, fno_flag.

    with_avg_value adds avg_20d_val; without that column the hard gate never passes.
    """
    w = series()
    df = bars.withColumn("avg_20d_vol", F.coalesce(mean_of_days(F.col("net_trdqty"), w), F.col("net_trdqty").cast("double")))
    names = ["avg_20d_vol"]
    if with_avg_value:
        df, names = df.withColumn("avg_20d_val", mean_of_days(F.col("net_trdval"), w)), [*names, "avg_20d_val"]
    value = F.col("net_trdval")
    fine = F.when(F.abs(value) >= EXACT_BELOW, value).alias("fine")
    df = staged(df.select("symbol", "trade_date", value.cast("double").alias("net_trdval"), "net_trdqty", "trades", F.col("close").cast("double").alias("close"), *names, fine), "turnover")
    df = ranks.with_shares(df, "trade_date", ["net_trdval", "fine"], "turnover_rank_pct", {"most_value": "net_trdval", "most_volume": "avg_20d_vol"})
    return df.select(
        "symbol",
        "trade_date",
        "net_trdval",
        "net_trdqty",
        "trades",
        "close",
        *names,
        "turnover_rank_pct",
        ratio_or_zero(F.col("net_trdval"), F.col("most_value")).alias("turnover_norm"),
        ratio_or_zero(F.col("avg_20d_vol"), F.col("most_volume")).alias("vol_norm"),
        F.lit(False).alias("fno_flag"),
    )


def with_gates(metrics: DataFrame, keep: float = KEEP, floors: dict[str, float] = FLOORS) -> DataFrame:
    """Metrics with hard_pass (all floors), pct_pass (among the day's ``keep`` share by turnover) and liquidity_pass (both)."""
    hard = F.lit(True)
    for name, floor in floors.items():
        hard = hard & ((F.coalesce(F.col(name), F.lit(0)) >= floor) if name in metrics.columns else F.lit(False))
    metrics = staged(metrics, "metrics")
    bounds = ranks.quantiles(ranks.ranked(metrics, "trade_date", "turnover_rank_pct"), "trade_date", "turnover_rank_pct", 1 - keep)
    share = F.coalesce(F.coalesce("turnover_rank_pct", F.lit(0.0)) >= F.col("quantile"), F.lit(False))
    metrics = metrics.join(bounds, "trade_date", "left")
    return metrics.withColumns({"hard_pass": hard, "pct_pass": share}).withColumn("liquidity_pass", F.col("hard_pass") & F.col("pct_pass")).drop("quantile")


def gated(metrics: DataFrame, mode: str = "tag", **how) -> DataFrame:
    """All rows with their gates (tag), or those that pass (enforce)."""
    df = with_gates(metrics, **how)
    return df.where("liquidity_pass") if mode == "enforce" else df


def combined_score(signals: DataFrame, metrics: DataFrame, weights=(0.6, 0.3, 0.1), boost: float = 1.0) -> DataFrame:
    """Signals with combined_score: weighted shares of the day's largest score, turnover and volume."""
    value = F.coalesce("avg_20d_val", "net_trdval", F.lit(0.0)) if "avg_20d_val" in metrics.columns else F.coalesce("net_trdval", F.lit(0.0))
    known = metrics.select("symbol", "trade_date", value.alias("value_of"), F.coalesce("avg_20d_vol", F.lit(0.0)).alias("volume_of"), "fno_flag")
    df = signals.join(known, ["symbol", "trade_date"], "left").fillna({"value_of": 0.0, "volume_of": 0.0, "fno_flag": False})
    return scored(df, weights, boost)


def with_figures(bars: DataFrame) -> DataFrame:
    """bars with the figures of their metrics that scores are made of: value_of, volume_of, fno_flag."""
    volume = F.coalesce(mean_of_days(F.col("net_trdqty"), series()), F.col("net_trdqty").cast("double"), F.lit(0.0))
    return bars.withColumns({"value_of": F.coalesce(F.col("net_trdval").cast("double"), F.lit(0.0)), "volume_of": volume, "fno_flag": F.lit(False)})


def scored(df: DataFrame, weights=(0.6, 0.3, 0.1), boost: float = 1.0) -> DataFrame:
    """combined_score() of signals that have value_of, volume_of and fno_flag."""
    day = Window.partitionBy("trade_date")
    size = F.abs(F.coalesce("signal_score", F.lit(0.0)))
    parts = [ratio_or_zero(c, F.max(c).over(day)) for c in (size, F.col("value_of"), F.col("volume_of"))]
    score = parts[0] * weights[0] + parts[1] * weights[1] + parts[2] * weights[2]
    return df.withColumn("combined_score", F.when(F.col("fno_flag"), score * boost).otherwise(score)).drop("value_of", "volume_of", "fno_flag")


def suggested_keep(universe: Column, target: Column) -> Column:
    """The share that keeps ``target`` of ``universe``, within 0.05 and 0.5, to 2 places; 0.3 of nothing."""
    return F.when(universe > 0, F.round(F.greatest(F.lit(0.05), F.least(F.lit(0.5), target / universe)), 2)).otherwise(F.lit(0.30))
