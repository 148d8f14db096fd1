"""Trading days: the calendar, the day before, and the day that a request stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Exchange holidays of 2026.
HOLIDAYS = (
    "2026-01-15 2026-01-26 2026-03-03 2026-03-26 2026-03-31 2026-04-03 2026-04-14 2026-05-01 "
    "2026-05-28 2026-06-26 2026-09-14 2026-10-02 2026-10-20 2026-11-10 2026-11-24 2026-12-25"
).split()


def calendar(spark: SparkSession, start: str, end: str, holidays=tuple(HOLIDAYS)) -> DataFrame:
    """Every day from start to end: trade_date, is_weekend, is_holiday, is_open, last_weekday (itself, or the Friday before)."""
    return marked(spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("trade_date")), holidays)


def marked(days: DataFrame, holidays=tuple(HOLIDAYS)) -> DataFrame:
    """days (trade_date) with is_weekend, is_holiday, is_open and last_weekday, as in calendar()."""
    weekend = F.weekday("trade_date") >= 5
    holiday = F.date_format("trade_date", "yyyy-MM-dd").isin(*holidays)
    friday = F.when(weekend, F.date_sub("trade_date", F.weekday("trade_date") - 4)).otherwise(F.col("trade_date"))
    return days.select("trade_date", weekend.alias("is_weekend"), holiday.alias("is_holiday"), (~weekend & ~holiday).alias("is_open"), friday.alias("last_weekday"))


def resolved(requests: DataFrame, bars: DataFrame) -> DataFrame:
    """requests (asked: a date or null) with trade_date: that day if it has bars, else the last day before with bars, else null; the last day of all for null.

    A week is the unit of the search: requests and days with bars meet in their week, and the last
    day of the weeks before is carried along.
    """
    days = bars.select("trade_date").distinct()
    last = F.lit(days.agg(F.max("trade_date")).first()[0]).cast("date")
    weeks = days.groupBy(F.date_trunc("week", "trade_date").cast("date").alias("w")).agg(F.sort_array(F.collect_list("trade_date")).alias("days"))  # seven at most
    asked = requests.select("asked").distinct().withColumn("w", F.date_trunc("week", "asked").cast("date"))
    both = weeks.join(asked.select("w").where("w is not null").distinct(), "w", "full")
    before = F.max(F.element_at("days", -1)).over(Window.orderBy("w").rowsBetween(Window.unboundedPreceding, -1))  # a row a week
    both = both.withColumn("before", before)
    df = asked.join(both, "w", "left")
    inside = F.array_max(F.filter("days", lambda d: d <= F.col("asked")))
    return df.select("asked", F.when(F.col("asked").isNull(), last).otherwise(F.coalesce(inside, "before")).alias("trade_date"))


def pending(dates: DataFrame, jobs: DataFrame) -> DataFrame:
    """Dates that no job finished, oldest first; a PARTIAL job counts as finished, a FAILED one doesn't."""
    done = jobs.where(F.col("status").isin("COMPLETED", "PARTIAL")).select("trade_date").distinct()
    return dates.select("trade_date").distinct().join(done, "trade_date", "left_anti").orderBy("trade_date")


def resolution_log(pending: DataFrame, controls: DataFrame, stocks: DataFrame) -> DataFrame:
    """Pending dates (trade_date) from the oldest to the first that is ready: step3_execution, stock_count, status and reason of each.

    A date is ready if controls has it; how many stocks were selected for it doesn't matter. Dates
    after the first ready one aren't looked at; where none is ready all are rejected.
    """
    have = controls.select("trade_date").distinct().withColumn("step3_execution", F.lit(True))
    counts = stocks.groupBy("trade_date").agg(F.count("*").alias("stocks"))
    df = pending.select("trade_date").distinct().join(have, "trade_date", "left").join(counts, "trade_date", "left")
    ready = F.coalesce("step3_execution", F.lit(False))
    first = F.min(F.when(ready, F.col("trade_date"))).over(Window.partitionBy(F.lit(0)))  # a row a date
    df = df.withColumn("ready", ready).withColumn("first", first).where(F.col("first").isNull() | (F.col("trade_date") <= F.col("first")))
    n = F.when(F.col("ready"), F.coalesce("stocks", F.lit(0))).otherwise(F.lit(0)).cast("long")
    reason = F.when(~F.col("ready"), "Missing step3_execution_control").when(n == 0, "Valid trade_date with no STEP3 selections").otherwise("Valid trade_date with STEP3 output")
    return df.select("trade_date", F.col("ready").alias("step3_execution"), n.alias("stock_count"), F.when(F.col("ready"), "SELECTED").otherwise("REJECTED").alias("status"), reason.alias("reason"))
