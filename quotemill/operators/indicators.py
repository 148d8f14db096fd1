"""Indicators over bars or candles: every window of a series shares one partitioning and one sort.

Sums are exact decimals, divided once. A mean over n rows needs ``need`` values that aren't null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quotemill.functions.coerce import exact, ratio
from quotemill.operators.segments import over_chunks


def series(by: str = "symbol", order: str = "day") -> WindowSpec:
    return Window.partitionBy(by).orderBy(order)


def previous(c: Column, w: WindowSpec, n: int = 1) -> Column:
    return F.lag(c, n).over(w)


def rolling_mean(c: Column, w: WindowSpec, n: int, need: int | None = None) -> Column:
    frame = w.rowsBetween(1 - n, 0)
    count = F.count(c).over(frame)
    return F.when(count >= (n if need is None else need), F.sum(exact(c)).over(frame).cast("double") / count)


def range_zero_fill(high: Column, low: Column, before: Column) -> Column:
    """True range; a term with a missing price is 0."""
    terms = [F.coalesce(F.abs(a - b), F.lit(0).cast("decimal(18,4)")) for a, b in ((high, low), (high, before), (low, before))]
    return F.greatest(*terms)


def range_skip_null(high: Column, low: Column, before: Column) -> Column:
    """True range over the terms that can be computed; high - low keeps its sign."""
    return F.greatest(high - low, F.abs(high - before), F.abs(low - before))


def range_propagate_null(high: Column, low: Column, before: Column) -> Column:
    """True range, null if any price is missing."""
    return F.when(high.isNotNull() & low.isNotNull() & before.isNotNull(), range_skip_null(high, low, before))


def strength(close: Column, w: WindowSpec, n: int = 14) -> tuple[Column, Column]:
    """Mean gain and mean loss of the last n changes, which must all be there."""
    change = close - previous(close, w)
    zero = F.lit(0).cast("decimal(18,4)")
    frame = w.rowsBetween(1 - n, 0)
    full = F.count(change).over(frame) >= n
    gain = F.sum(exact(F.greatest(change, zero))).over(frame)
    loss = F.sum(exact(F.greatest(-change, zero))).over(frame)
    return F.when(full, gain.cast("double") / n), F.when(full, loss.cast("double") / n)


def rsi_null_on_zero_loss(close: Column, w: WindowSpec, n: int = 14) -> Column:
    gain, loss = strength(close, w, n)
    return 100 - 100 / (1 + ratio(gain, loss))


def rsi_epsilon(close: Column, w: WindowSpec, n: int = 14) -> Column:
    gain, loss = strength(close, w, n)
    return 100 - 100 / (1 + gain / (loss + 1e-8))


def momentum(close: Column, w: WindowSpec, n: int = 20) -> Column:
    """Change over n rows in percent; missing closes are filled with the last one before."""
    filled = F.last(close, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (ratio(filled, F.last(close, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -n))) - 1) * 100


def high_before(high: Column, w: WindowSpec, days: int = 20) -> Column:
    """Highest high of the calendar days before, w being ordered by day number."""
    return F.max(high).over(w.rangeBetween(-days, -1))


def mean_of_days(c: Column, w: WindowSpec, days: int = 40) -> Column:
    """Mean over the last calendar days, today included."""
    frame = w.rangeBetween(-days, 0)
    return F.sum(c).over(frame).cast("double") / F.count(c).over(frame)


def with_features(bars: DataFrame) -> DataFrame:
    """Bars with prev_close, mom_20, atr_14, rsi_14 and prior_high; all from one exchange and one sort."""
    w = series()
    df = bars.withColumn("prev_close", previous(F.col("close"), w))
    df = df.withColumn("true_range", range_zero_fill(F.col("high"), F.col("low"), F.col("prev_close")))
    return df.withColumns(
        {
            "mom_20": momentum(F.col("close"), w),
            "atr_14": rolling_mean(F.col("true_range"), w, 14),
            "rsi_14": F.round(rsi_null_on_zero_loss(F.col("close"), w), 6),
            "prior_high": high_before(F.col("high"), w),
        }
    ).drop("true_range")


def long_features(features: DataFrame) -> DataFrame:
    """(trade_date, symbol, feature_name, value) for features that have a value."""
    names = ("mom_20", "atr_14", "rsi_14")
    pairs = F.array(*[F.struct(F.lit(n).alias("feature_name"), F.col(n).alias("value")) for n in names])
    return features.select("trade_date", "symbol", F.inline(F.filter(pairs, lambda x: x["value"].isNotNull())))


def candle_indicators(candles: DataFrame, by: tuple[str, ...] = (), order: str = "ts", width: str = "7 days") -> DataFrame:
    """Candles with sma_5, sma_20, rsi and atr; rows before all four exist are dropped. Indicators go on across sessions, and series are cut in chunks of time."""
    c = F.col("close")

    def with_all(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(order)
        rows = rows.withColumn("true_range", range_propagate_null(F.col("high"), F.col("low"), previous(c, w)))
        return rows.withColumns({"sma_5": rolling_mean(c, w, 5), "sma_20": rolling_mean(c, w, 20), "rsi": rsi_epsilon(c, w), "atr": rolling_mean(F.col("true_range"), w, 14)})

    df = over_chunks(candles, list(by), 20, with_all, order, width)
    return df.drop("true_range").dropna(subset=["sma_5", "sma_20", "rsi", "atr", "open", "high", "low", "close"])
