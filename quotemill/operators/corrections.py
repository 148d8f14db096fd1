"""Corrected and late bars: only what a change can reach is computed again.

A feature of a bar looks back over REACH_ROWS rows of its symbol and REACH_DAYS calendar days. A
change therefore reaches as many rows and days forward, and these need as many rows before them: the
halo. A halo is read by days, so that a store in months is pruned; symbols with too few rows in
it are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators import indicators

#: What a feature can depend on; days of history that are read before a symbol's first change.
REACH_ROWS, REACH_DAYS, HALO_DAYS = 20, 20, 80
FEATURES = ("prev_close", "mom_20", "atr_14", "rsi_14", "prior_high")


def changed_keys(old: DataFrame, new: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """symbol, trade_date of the bars that were added, removed or are different in one of the columns."""
    a, b = (df.select("symbol", "trade_date", F.struct(*columns).alias(name)) for df, name in ((old, "was"), (new, "is")))
    return a.join(b, ["symbol", "trade_date"], "full").where(~F.col("was").eqNullSafe(F.col("is"))).select("symbol", "trade_date")


def needed(bars: DataFrame, changed: DataFrame, halo_days: int = HALO_DAYS) -> DataFrame:
    """The bars that the changes' features are made of: from the halo before a symbol's first change on."""
    first = changed.groupBy("symbol").agg(F.min("trade_date").alias("first_change"))
    least = first.agg(F.min("first_change").alias("d")).first()["d"]
    if least is None:
        return bars.limit(0)
    since = F.date_sub(F.lit(least), halo_days)
    late = bars.where(F.col("trade_date") >= since)
    late = (late.where(F.col("month") >= F.trunc(since, "month")) if "month" in bars.columns else late).join(first, "symbol")  # a store's folders by month
    before = late.where((F.col("trade_date") < F.col("first_change")) & (F.col("trade_date") >= F.date_sub("first_change", halo_days))).groupBy("symbol").agg(F.count("close").alias("n"))  # closes, since missing ones are carried on
    enough = before.where(F.col("n") > REACH_ROWS).select("symbol")
    late = late.where(F.col("trade_date") >= F.date_sub("first_change", halo_days)).drop("first_change")
    return late.join(enough, "symbol", "left_semi").unionByName(bars.join(first.select("symbol"), "symbol", "left_semi").join(enough, "symbol", "left_anti"))


def reached(bars: DataFrame, changed: DataFrame) -> DataFrame:
    """symbol, trade_date of the bars whose features a change can reach; a removed bar reaches those after it."""
    rows = bars.select("symbol", "trade_date", F.lit(False).alias("mark")).unionByName(changed.select("symbol", "trade_date", F.lit(True).alias("mark")))
    w = Window.partitionBy("symbol").orderBy("day")
    rows = rows.groupBy("symbol", "trade_date").agg(F.bool_or("mark").alias("mark"), F.bool_or(~F.col("mark")).alias("there")).withColumn("day", F.unix_date("trade_date"))
    hit = F.max("mark").over(w.rowsBetween(-REACH_ROWS - 1, 0)) | F.coalesce(F.max("mark").over(w.rangeBetween(-REACH_DAYS, 0)), F.lit(False))
    return rows.withColumn("hit", hit).where("hit and there").select("symbol", "trade_date")


def corrected_features(features: DataFrame, bars: DataFrame, changed: DataFrame, halo_days: int = HALO_DAYS) -> DataFrame:
    """features (symbol, trade_date, FEATURES) of the bars as they were, made those of the bars as they are: only reached rows are new."""
    near = needed(bars, changed, halo_days)
    keys = ["symbol", "trade_date"]
    new = indicators.with_features(near).select(*keys, *FEATURES).join(reached(near, changed), keys, "left_semi")
    gone = new.select(*keys).unionByName(changed.select(*keys)).distinct()
    return features.select(*keys, *FEATURES).join(gone, keys, "left_anti").unionByName(new)


def corrected_dates(changed: DataFrame, bars: DataFrame, halo_days: int = HALO_DAYS) -> DataFrame:
    """trade_date, once, of the days whose ranks and signals a change can reach, and the day before each for entries at the next open."""
    days = reached(needed(bars, changed, halo_days), changed).select("trade_date").unionByName(changed.select("trade_date"))
    return days.unionByName(changed.select(F.date_sub("trade_date", 1).alias("trade_date"))).distinct()


def replaced_dates(old: DataFrame, new: DataFrame, dates: DataFrame) -> DataFrame:
    """old with all rows of the dates taken from new."""
    return old.join(dates, "trade_date", "left_anti").unionByName(new.join(dates, "trade_date", "left_semi").select(*old.columns))


def since(bars: DataFrame, dates: DataFrame, halo_days: int = HALO_DAYS) -> DataFrame:
    """The bars that the dates' signals are made of: of every symbol its halo before the first of them on, or all where that has too few."""
    least = dates.agg(F.min("trade_date").alias("d")).first()["d"]
    if least is None:
        return bars.limit(0)
    return needed(bars, bars.where(F.col("trade_date") >= F.lit(least)).groupBy("symbol").agg(F.lit(least).alias("trade_date")), halo_days)
