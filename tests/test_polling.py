"""Polls of report lists: against a plain poller, over several runs, and after a crash."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotemill.operators import scans
from quotemill.sources import store
from quotemill.streaming import polling

SCHEMA = "source string, poll_at timestamp_ntz, poll_id long, json string"
CLOSED = ("2024-03-08",)
FOUND = ("source", "poll_at", "poll_id", "target_date", "outcome", "file")


def listing(*entries):
    return json.dumps({"CurrentDay": [{"file": f, "tradingDate": d.strftime("%d-%b-%Y")} for f, d in entries]})


def name(day):
    return f"PR{day:%d%m%y}.zip"


def plain(polls):
    """One source's polls of one day, in order of time and id."""
    out, done = [], set()
    for source, at, poll, text in sorted(polls, key=lambda p: (p[1], p[2])):
        day = at.date()
        target = day if at.hour in (19, 20, 21) else day - dt.timedelta(1) if at.hour == 7 else None
        found = None
        if str(day) in CLOSED:
            outcome = "skip_holiday"
        elif (source, day) in done:
            outcome = "skip_done"
        elif target is None:
            outcome = "skip_hour"
        elif str(target) in CLOSED:
            outcome = "holiday"
        else:
            try:
                lists = json.loads(text or "")
            except ValueError:
                lists = None
            entries = [e for k in ("CurrentDay", "PreviousDay", "FutureDay") for e in lists.get(k) or []] if lists else []
            hit = [e for e in entries if e["file"] == name(target)] or [e for e in entries if e["tradingDate"] == target.strftime("%d-%b-%Y")]
            outcome = "failed" if not lists else "downloaded" if hit else "pending"
            if hit:
                found = hit[0]["file"]
                if target == day:
                    done.add((source, day))
        out.append((source, at, poll, None if outcome.startswith("skip") else target, outcome, found))
    return Counter(out)


def random_polls(r, n):
    out = []
    for k in range(n):
        at = dt.datetime(2024, 3, r.randrange(5, 13), r.choice((6, 7, 7, 18, 19, 20, 21, 22)), r.randrange(60))
        day = at.date() - dt.timedelta(at.hour == 7)
        text = r.choice((None, "", "{}", "[1, broken", listing(), listing(("x.zip", day)), listing(("x.zip", day), (name(day), day)), listing((name(day), day - dt.timedelta(9))), listing(("y.zip", day + dt.timedelta(1)))))
        out.append((r.choice(("a", "b", None)), at, k, text))
    return out


def frame(spark, polls):
    return spark.createDataFrame(polls, SCHEMA)


def as_rows(df):
    return Counter(tuple(x) for x in df.select(*FOUND).collect())


def test_decisions_against_a_plain_poller(spark):
    polls = random_polls(random.Random(1), 600)
    want = plain(polls)
    assert as_rows(polling.decided(frame(spark, polls).repartition(5), ["source"], CLOSED)) == want
    assert {x[4] for x in want} == {"skip_holiday", "skip_done", "skip_hour", "holiday", "failed", "pending", "downloaded"}


def test_several_runs_decide_as_one_does_and_a_lost_batch_comes_again(spark, tmp_path, monkeypatch):
    polls = sorted(random_polls(random.Random(2), 240), key=lambda p: (p[1], p[2]))
    lists, root, state = (str(tmp_path / x) for x in ("lists", "decided", "state"))

    def run():
        query = polling.poll_reports(spark.readStream.schema(SCHEMA).parquet(lists), ["source"], root, state, CLOSED)
        query.awaitTermination()

    cuts = [0, 70, 71, 160, 240]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):  # days are cut through, so that what is done is known from the ledger alone
        frame(spark, polls[a:b]).coalesce(1).write.mode("append").parquet(lists)
        if k == 2:
            with monkeypatch.context() as m:
                m.setattr(store, "put", lambda *_: 1 / 0)
                with pytest.raises(Exception, match="ZeroDivisionError|division"):
                    run()
            assert as_rows(store.read_batches(spark, root)) == plain(polls[:a])
        run()
        assert as_rows(store.read_batches(spark, root)) == plain(polls[:b])
    run()  # nothing new
    assert as_rows(store.read_batches(spark, root)) == plain(polls)


def test_empty_null_and_repeated_polls(spark):
    assert as_rows(polling.decided(frame(spark, []), ["source"])) == Counter()
    at, day = dt.datetime(2024, 3, 5, 19, 0), dt.date(2024, 3, 5)
    twice = ("a", at, 1, listing((name(day), day)))
    got = as_rows(polling.decided(frame(spark, [twice, twice, (None, None, None, None), ("a", at, 2, None)]), ["source"]))
    assert got == Counter({("a", at, 1, day, "downloaded", name(day)): 2, (None, None, None, None, "skip_hour", None): 1, ("a", at, 2, None, "skip_done", None): 1})


def test_columns_of_the_same_names_are_left_alone(spark):
    at, day = dt.datetime(2024, 3, 5, 19, 0), dt.date(2024, 3, 5)
    polls = frame(spark, [("a", at, 1, listing((name(day), day)))]).withColumns({c: F.lit("mine") for c in ("day", "target_date", "file", "said", "first_", "outcome")})
    assert as_rows(polling.decided(polls, ["source"])) == Counter({("a", at, 1, day, "downloaded", name(day)): 1})


def test_the_named_entry_wins_over_an_earlier_one_of_the_day(spark):
    day = dt.date(2024, 3, 5)
    rows = [(1, listing(("x.zip", day), (name(day), day))), (2, listing(("x.zip", day), ("y.zip", day))), (3, listing(("x.zip", dt.date(2024, 3, 6)))), (4, None), (5, "no list")]
    df = spark.createDataFrame(rows, "k int, json string").withColumn("day", F.lit(day))
    got = df.select("k", scans.listed(F.col("json"), F.lit(name(day)), F.col("day"))["file"].alias("file")).collect()
    assert {r["k"]: r["file"] for r in got} == {1: name(day), 2: "x.zip", 3: None, 4: None, 5: None}
