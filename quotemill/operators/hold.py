"""How long a position is expected to be held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.barriers import with_steps

LEAST, MOST = 1, 30


def days_to_barrier(bars: DataFrame, target: float = 0.01, stop: float = 0.005, ahead: int = 30) -> DataFrame:
    """symbol, trade_date, days: rows until a high reaches the close times 1+target, or a low the close times 1-stop; null beyond ``ahead``."""
    return with_barrier(bars, target, stop, ahead).where("close > 0").select("symbol", "trade_date", "days")


def with_barrier(bars: DataFrame, target: float = 0.01, stop: float = 0.005, ahead: int | None = 30, width: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """bars with days, null where the close isn't above 0; ahead None: however far the barrier is. width: for series that are cut in chunks of so much time. keep: the columns of bars that are wanted, all by default."""
    above = F.when(F.col("close") > 0, F.col("close"))
    up, down = above * F.lit(str(1 + target)).cast("decimal(10,4)"), above * F.lit(str(1 - stop)).cast("decimal(10,4)")
    found = with_steps(bars, ["symbol"], "trade_date", "high", "low", up, down, width, keep)
    return found.withColumn("days", F.when(F.col("steps") <= ahead, F.col("steps")) if ahead else F.col("steps")).drop("steps")


def clamp(days: Column) -> Column:
    return F.greatest(F.lit(LEAST), F.least(F.lit(MOST), days.cast("bigint"))).cast("bigint")


def empirical_hold(bars: DataFrame, target: float = 0.01, stop: float = 0.005, lookback: int = 282, least_bars: int = 10, least_samples: int = 8) -> DataFrame:
    """symbol, samples, days: the median of days_to_barrier over the latest bars, rounded up; null with too few bars or samples. Only bars with a close above 0 count."""
    w = Window.partitionBy("symbol")
    nth, all_ = F.row_number().over(w.orderBy("trade_date")), F.count("*").over(w)  # counted from the first, in the order that the search needs as well
    recent = bars.select("symbol", "trade_date", "high", "low", "close").withColumn("left", all_ - nth).where(F.col("left") < lookback)
    found = with_barrier(recent.withColumn("priced", F.col("close") > 0), target, stop, keep=["symbol", "priced"]).where("priced").groupBy("symbol").agg(F.count("*").alias("bars"), F.count("days").alias("samples"), F.percentile("days", F.lit(0.5)).alias("middle"))
    enough = (F.col("bars") >= least_bars) & (F.col("samples") >= least_samples)
    return found.select("symbol", F.col("samples").cast("bigint").alias("samples"), F.when(enough, clamp(F.ceil("middle"))).alias("days"))


def atr_hold(atr: Column, target: float = 3.0, factor: float = 1.0) -> Column:
    return F.when(atr > 0, clamp(F.ceil(atr * target / F.greatest(F.lit(1e-6), atr * factor))))


def score_hold(score: Column, base: int = 7) -> Column:
    """Rounded half to even."""
    return F.when(score.isNotNull(), clamp(F.rint(F.lit(float(base)) * (1 - F.least(F.lit(0.6), F.abs(score) / 10)))))


def hold_cascade(signals: DataFrame, empirical: DataFrame, features: DataFrame | None = None, default: int = 7) -> DataFrame:
    """Signals with hold_days and hold_method: empirical, else by ATR, else by score, else the default. Without ``features`` the signals have atr_14 themselves."""
    df = signals.join(empirical.select("symbol", "days"), "symbol", "left")
    if features is not None:
        df = df.join(features.select("symbol", "trade_date", "atr_14"), ["symbol", "trade_date"], "left")
    ways = (("empirical", F.col("days")), ("atr", atr_hold(F.col("atr_14"))), ("score", score_hold(F.col("signal_score"), default)), ("fallback", F.lit(default).cast("bigint")))
    method = F.coalesce(*[F.when(days.isNotNull(), F.lit(name)) for name, days in ways])
    return df.withColumn("hold_days", F.coalesce(*[d for _, d in ways])).withColumn("hold_method", method).drop("days", "atr_14")
