"""Polls of report lists, gated by hour: in the evening today's file is tried for, in the morning yesterday's.

A poll is a row: its keys (a source), the time at the exchange, an id, and the list as it stood then.
What it finds depends on its row alone. Whether its day is done already is known from the polls
before it: those of the same micro-batch, and by the ledger those of all earlier batches. Offsets
are the file source's own, in the checkpoint, so that a batch that is run again decides the same.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotemill.operators.scans import listed
from quotemill.operators.trading_days import HOLIDAYS
from quotemill.sources import store

#: Hours that try for the day itself, and for the day before.
EVENING, MORNING = (19, 20, 21), (7,)
FOUND = "downloaded"


def _closed(day: Column, holidays: tuple[str, ...]) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM-dd").isin(*holidays), F.lit(False))


def attempts(polls: DataFrame, keys: list[str], holidays: tuple[str, ...]) -> DataFrame:
    """keys, poll_at, poll_id, day, target_date, file, said: what each poll comes to if its day isn't done.

    The first entry with the file's name counts, else the first of the target's date. A list that
    can't be read, or is empty, fails; a target without an entry stays pending.
    """
    day, hour = F.to_date("poll_at"), F.hour("poll_at")
    target = F.when(hour.isin(*EVENING), day).when(hour.isin(*MORNING), F.date_sub(day, 1))
    rows = polls.select(*keys, "poll_at", "poll_id", "json", day.alias("day"), target.alias("target_date"))
    name = F.concat(F.lit("PR"), F.date_format("target_date", "ddMMyy"), F.lit(".zip"))
    rows = rows.withColumn("file", listed(F.col("json"), name, F.col("target_date"))["file"])
    whole = F.get_json_object("json", "$")
    said = (
        F.when(_closed(F.col("day"), holidays), "skip_holiday")
        .when(F.col("target_date").isNull(), "skip_hour")
        .when(_closed(F.col("target_date"), holidays), "holiday")
        .when(whole.isNull() | whole.isin("{}", "[]", "null", ""), "failed")
        .when(F.col("file").isNull(), "pending")
        .otherwise(FOUND)
    )
    return rows.withColumn("said", said).drop("json")


def decided(polls: DataFrame, keys: list[str], holidays: tuple[str, ...] = tuple(HOLIDAYS), known: DataFrame | None = None) -> DataFrame:
    """keys, poll_at, poll_id, target_date, outcome, file of each poll (keys, poll_at without zone, poll_id, json).

    known: decisions from before. A poll after one that found its own day's file is skipped, in any
    hour but on holidays; so a morning's poll, which is for the day before, is never skipped for that
    day's sake. Polls at one time go by id. One without a time is out of hours; null keys are a
    source like any other; of equal rows none is after the other, so that both are tried.
    """
    rows = attempts(polls, keys, holidays)
    done = rows.where((F.col("said") == FOUND) & (F.col("target_date") == F.col("day"))).select(*keys, "day", "poll_at", "poll_id")
    if known is not None:
        before = known.where((F.col("outcome") == FOUND) & (F.col("target_date") == F.to_date("poll_at")))
        done = done.unionByName(before.select(*keys, F.col("target_date").alias("day"), "poll_at", "poll_id"))
    done = done.groupBy(*[F.col(c).alias(f"{c}_") for c in (*keys, "day")]).agg(F.min(F.struct("poll_at", "poll_id")).alias("first_"))
    rows = rows.join(done, reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in (*keys, "day")]), "left")
    late = F.coalesce(F.struct("poll_at", "poll_id") > F.col("first_"), F.lit(False)) & (F.col("said") != "skip_holiday")
    tried = ~late & ~F.col("said").startswith("skip_")
    return rows.select(
        *keys, "poll_at", "poll_id",
        F.when(tried, F.col("target_date")).alias("target_date"),
        F.when(late, "skip_done").otherwise(F.col("said")).alias("outcome"),
        F.when(tried & (F.col("said") == FOUND), F.col("file")).alias("file"),
    )


def decide_batch(polls: DataFrame, batch: int, root: str, keys: list[str], holidays: tuple[str, ...]) -> bool:
    """A micro-batch's decisions, written once; of those from before only the batch's days are read."""
    spark, known = polls.sparkSession, None
    if store.exists(spark, f"{root}/ledger/{batch}"):
        return False
    if store.exists(spark, f"{root}/ledger"):
        first, last = polls.agg(F.min(F.to_date("poll_at")), F.max(F.to_date("poll_at"))).first()
        known = store.read_batches(spark, root).where(F.col("target_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return store.write_batch(decided(polls, keys, holidays, known), batch, root)


def poll_reports(polls: DataFrame, keys: list[str], root: str, checkpoint: str, holidays: tuple[str, ...] = tuple(HOLIDAYS)) -> StreamingQuery:
    """Decides all polls that are there and haven't been decided yet; ``store.read_batches`` gives the decisions.

    A source's polls of one day come in order of time, as a poller writes them, or together. One that
    comes later than its time is judged by what was found before that time, and may find a file a
    second time, which a sink by target_date replaces with itself.
    """
    return polls.writeStream.foreachBatch(lambda df, n: decide_batch(df, n, root, keys, holidays) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
