"""Outcomes of signals against the bar of their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.coerce import ratio

NO_BAR = "missing bar"
NO_PRICE = "missing entry, high, low or close"
BOTH = "stop and target both inside the bar"
NEITHER = "neither stop nor target reached; exit at close"


def label_outcomes(signals: DataFrame, bars: DataFrame) -> DataFrame:
    """Signals with side, entry_used, label, exit_price, exit_reason, ambiguous, realized_return (percent) and note.

    A missing entry falls back to the bar's open. A side that isn't given follows from the target.
    A bar that reaches both stop and target is ambiguous: neutral, without an exit.
    """
    day = with_bar(bars).select("symbol", "trade_date", *BAR)
    return outcomes(signals.join(day, ["symbol", "trade_date"], "left"))


BAR = ("bar_open", "bar_high", "bar_low", "bar_close", "has_bar")


def with_bar(bars: DataFrame) -> DataFrame:
    """bars with their prices as doubles under other names, and has_bar."""
    return bars.withColumns({f"bar_{c}": F.col(c).cast("double") for c in ("open", "high", "low", "close")} | {"has_bar": F.lit(True)})


def outcomes(df: DataFrame) -> DataFrame:
    """label_outcomes() of signals that have their bar's columns (BAR)."""
    entry, stop, target = F.coalesce("entry_price", "bar_open"), F.col("stop_price"), F.col("target_price")
    high, low, close = F.col("bar_high"), F.col("bar_low"), F.col("bar_close")
    given = F.upper(F.trim("signal_type"))
    guess = F.when((entry != 0) & (target != 0) & (target < entry), "SHORT").otherwise("LONG")
    df = df.withColumn("side", F.when(given.isin("LONG", "SHORT"), given).otherwise(guess)).withColumn("entry_used", entry)
    long = F.col("side") == "LONG"
    yes = lambda c: F.coalesce(c, F.lit(False))
    hit_target = yes(F.when(long, high >= target).otherwise(low <= target))
    hit_stop = yes(F.when(long, low <= stop).otherwise(high >= stop))
    priced = F.col("entry_used").isNotNull() & high.isNotNull() & low.isNotNull() & close.isNotNull()
    both = priced & hit_target & hit_stop
    df = df.withColumns(
        {
            "ambiguous": F.when(both, 1).otherwise(0),
            "label": F.when(~priced | both, "neutral").when(hit_target, "win").when(hit_stop, "loss").otherwise("neutral"),
            "exit_price": F.when(~priced | both, F.lit(None)).when(hit_target, target).when(hit_stop, stop).otherwise(close),
            "exit_reason": F.when(~priced | both, F.lit(None)).when(hit_target, "target").when(hit_stop, "stop").otherwise("close"),
            "note": F.when(F.col("has_bar").isNull(), NO_BAR).when(~priced, NO_PRICE).when(both, BOTH).when(hit_target | hit_stop, "").otherwise(NEITHER),
        }
    )
    move = F.when(F.col("side") == "LONG", F.col("exit_price") - F.col("entry_used")).otherwise(F.col("entry_used") - F.col("exit_price"))
    return df.withColumn("realized_return", ratio(move, F.col("entry_used")) * 100).drop("has_bar", "bar_open")


def tallies(labels: DataFrame) -> DataFrame:
    count = lambda label: F.count_if(F.col("label") == label).alias(label)
    return labels.groupBy("strategy").agg(F.count("*").alias("signals"), count("win"), count("loss"), count("neutral"), F.sum("ambiguous").cast("bigint").alias("ambiguous"))


def unprocessed(dates: DataFrame, done: DataFrame) -> DataFrame:
    """Distinct dates that aren't done."""
    return dates.select("trade_date").distinct().join(done.select("trade_date").distinct(), "trade_date", "left_anti")
