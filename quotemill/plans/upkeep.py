"""Queries of tables that change: status as a stream, corrected bars, merges, and series too long for a task."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.functions import names
from quotemill.functions.coerce import exact, ratio
from quotemill.operators import corrections, hold, indicators, labels, risk, rules, segments, selection, trading_days
from quotemill.plans.catalogue import GAP, OHLC, classified, doubles
from quotemill.plans.fragments import CANDLES_SQL, FEATURES_SQL, LABELS_SQL, SELECTION_SQL
from quotemill.plans.queries import query
from quotemill.sources import archive, manifest, store
from quotemill.sources.standin import BARS_SQL, bars, candles
from quotemill.sources.table_io import new_folder, staged, table
from quotemill.streaming import polling, status

#: Rules of the daily rates in the order they are tried: metric, place, comparison, bound, label; the last metric has a gap that no rule covers.
RULES = (
    ("conversion_rate", 0, "lt", 0.2, "VERY_LOW"),
    ("conversion_rate", 1, "lt", 0.4, "LOW"),
    ("conversion_rate", 2, "gte", 0.4, "GOOD"),
    ("failure_rate", 0, "gt", 0.5, "HIGH"),
    ("failure_rate", 1, "lte", 0.5, "CONTROLLED"),
    ("missed_opportunity_rate", 0, "gt", 0.3, "HIGH"),
    ("missed_opportunity_rate", 1, "lt", 0.1, "LOW"),
)

# status of jobs

#: What an event says about the day's job of its user.
PROPOSED = {"signup": "pending", "view": "downloaded", "click": "committed", "purchase": "success", "error": "failed"}
_PROPOSED_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PROPOSED.items()) + " END"
_MOVES_SQL = ", ".join(f"('{a}', '{b}')" for a, to in status.MOVES.items() for b in to)
_OPEN_SQL = ", ".join(f"'{x}'" for x in status.OPEN)


@query(
    f"""WITH RECURSIVE mark AS (SELECT (epoch_ms(max(ts)) - 600000) * 1000 + 999 AS passed FROM events),
    said AS (SELECT user_id, ts::DATE AS target_date, event_id, epoch_us(ts) AS at_us, {_PROPOSED_SQL} AS proposed, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS nth FROM events, mark WHERE epoch_us(ts) <= passed),
    moves(a, b) AS (VALUES {_MOVES_SQL}),
    fold AS (
      SELECT user_id, target_date, 0::BIGINT AS nth, NULL::BIGINT AS event_id, 0::BIGINT AS at_us, '' AS from_state, '' AS proposed, '' AS to_state, false AS accepted, 0::BIGINT AS since FROM said WHERE nth = 1
      UNION ALL
      SELECT n.user_id, n.target_date, n.nth, n.event_id, n.at_us, n.state, n.proposed, CASE WHEN m.b IS NULL THEN n.state ELSE n.proposed END, m.b IS NOT NULL, CASE WHEN m.b IS NULL THEN n.began ELSE n.at_us END
      FROM (SELECT s.*, CASE WHEN f.to_state IN ({_OPEN_SQL}) AND f.since + {status.EXPIRY} < s.at_us THEN 'failed' ELSE f.to_state END AS state, CASE WHEN f.to_state IN ({_OPEN_SQL}) AND f.since + {status.EXPIRY} < s.at_us THEN f.since + {status.EXPIRY} ELSE f.since END AS began
            FROM fold f JOIN said s ON s.user_id = f.user_id AND s.target_date = f.target_date AND s.nth = f.nth + 1) n LEFT JOIN moves m ON m.a = n.state AND m.b = n.proposed
    ), after AS (SELECT *, lead(at_us) OVER (PARTITION BY user_id, target_date ORDER BY nth) AS next_us, lead(from_state) OVER (PARTITION BY user_id, target_date ORDER BY nth) AS next_state FROM fold)
    SELECT user_id, target_date, event_id, at_us, from_state, proposed, to_state, accepted FROM fold WHERE nth > 0
    UNION ALL SELECT user_id, target_date, NULL, since + {status.EXPIRY}, to_state, 'failed', 'failed', true FROM after, mark
    WHERE to_state IN ({_OPEN_SQL}) AND CASE WHEN next_us IS NULL THEN since + {status.EXPIRY} <= passed // 1000 * 1000 ELSE since + {status.EXPIRY} < next_us END"""
)
def status_machine(spark, sf_dir):
    """The day's job of each user by its events, as a stream that runs until it has caught up; each micro-batch is written once, by ledger."""
    folder = new_folder(spark, "status")
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events*.parquet")
    said = F.create_map(*[F.lit(x) for pair in PROPOSED.items() for x in pair])
    events = events.select("user_id", F.to_date("ts").alias("target_date"), F.col("ts").cast("timestamp").alias("ts"), "event_id", said[F.col("event_type")].alias("proposed"))
    with status.state_store(spark):
        rows = status.status_stream(events, ["user_id", "target_date"])
        run = rows.writeStream.foreachBatch(lambda df, batch: store.write_batch(df, batch, folder) and None)
        run.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return store.read_batches(spark, folder).select("user_id", "target_date", "event_id", "at_us", "from_state", "proposed", "to_state", "accepted")


# polls of report lists

#: The known holidays, moved into a year that has orders.
_CLOSED = tuple(f"1996{x[4:]}" for x in trading_days.HOLIDAYS)
_CLOSED_SQL = ", ".join(f"DATE '{x}'" for x in _CLOSED)


def _polls(spark, sf_dir):
    """Every order is a poll of a list that holds its target's file by name, only by date, not at all, or that can't be read."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", F.to_date("o_orderdate").alias("day"))
    hour, kind = F.element_at(F.array(*[F.lit(h) for h in (7, 12, 19, 20, 21, 22)]), (F.col("o_orderkey") % 6 + 1).cast("int")), F.col("o_orderkey") % 7
    at = F.to_timestamp_ntz(F.format_string("%s %02d:%02d:00", F.col("day").cast("string"), hour, F.col("o_custkey") % 60))
    target = F.when(hour == 7, F.date_sub("day", 1)).otherwise(F.col("day"))
    entry = lambda file, day: F.array(F.struct(file.alias("file"), F.date_format(day, "dd-MMM-yyyy").alias("tradingDate")))
    other = entry(F.lit("other.zip"), F.when(kind == 1, F.date_add(target, 1)).otherwise(target))
    named = F.when(kind > 2, entry(F.concat(F.lit("PR"), F.date_format(target, "ddMMyy"), F.lit(".zip")), target))
    text = F.when(kind == 0, "[1, broken").otherwise(F.to_json(F.struct(other.alias("CurrentDay"), named.alias("FutureDay"))))
    return rows.select(F.col("o_orderstatus").alias("source"), at.alias("poll_at"), F.col("o_orderkey").alias("poll_id"), text.alias("json"))


@query(
    f"""WITH polls AS (SELECT o_orderstatus AS source, o_orderkey AS poll_id, o_orderdate::DATE AS day, [7, 12, 19, 20, 21, 22][o_orderkey % 6 + 1] AS hour, o_custkey % 60 AS minute, o_orderkey % 7 AS kind FROM orders),
    aimed AS (SELECT *, CASE WHEN hour = 7 THEN day - 1 WHEN hour BETWEEN 19 AND 21 THEN day END::DATE AS target FROM polls),
    said AS (SELECT *, CASE WHEN day IN ({_CLOSED_SQL}) THEN 'skip_holiday' WHEN target IS NULL THEN 'skip_hour' WHEN target IN ({_CLOSED_SQL}) THEN 'holiday' WHEN kind = 0 THEN 'failed' WHEN kind = 1 THEN 'pending' ELSE 'downloaded' END AS said FROM aimed),
    told AS (SELECT *, said <> 'skip_holiday' AND coalesce(min(CASE WHEN said = 'downloaded' AND target = day THEN row(hour, minute, poll_id) END) OVER (PARTITION BY source, day) < row(hour, minute, poll_id), false) AS late FROM said)
    SELECT source, poll_id, CASE WHEN late OR said LIKE 'skip%' THEN NULL ELSE target END AS target_date, CASE WHEN late THEN 'skip_done' ELSE said END AS outcome,
      CASE WHEN late OR said <> 'downloaded' THEN NULL WHEN kind = 2 THEN 'other.zip' ELSE 'PR' || strftime(target, '%d%m%y') || '.zip' END AS file FROM told"""
)
def report_polls(spark, sf_dir):
    """A folder of report lists, polled until it has caught up, and again after the later hours' lists came: these know from the ledger which days are done."""
    folder, rows = new_folder(spark, "polls"), _polls(spark, sf_dir)
    for late in (False, True):
        rows.where((F.hour("poll_at") >= 20) == late).write.mode("append").parquet(f"{folder}/lists")
        lists = spark.readStream.schema(rows.schema).parquet(f"{folder}/lists")
        polling.poll_reports(lists, ["source"], f"{folder}/decided", f"{folder}/state", _CLOSED).awaitTermination()
    return store.read_batches(spark, f"{folder}/decided").select("source", "poll_id", "target_date", "outcome", "file")


# corrections

#: Bars from here on may have been corrected late; the earlier ones stand.
LATE = "2001-08-01"


def _corrected(spark, sf_dir):
    """(bars as they were, bars as they are, the changes): of the late ones some had other prices, some weren't there and some have gone."""
    now = staged(bars(spark, sf_dir), "bars")  # read many times
    late, kind = F.col("trade_date") >= F.lit(LATE).cast("date"), F.pmod(F.crc32(F.concat("symbol", F.col("trade_date").cast("string")).cast("binary")), F.lit(5))
    old = now.where(~(late & (kind == 0))).withColumns({c: F.when(late & (kind == 1), (F.col(c) * 2).cast("decimal(18,2)")).otherwise(F.col(c)) for c in OHLC})
    gone = now.where(late & (kind == 2)).withColumns({"trade_date": F.date_add("trade_date", 200), "day": F.col("day") + 200})
    old = old.unionByName(gone.join(now.select("symbol", "trade_date"), ["symbol", "trade_date"], "left_anti").select(*old.columns))
    return old, now, staged(corrections.changed_keys(old.where(late), now.where(late), OHLC), "changed")


@query(f"WITH {FEATURES_SQL} SELECT symbol, trade_date, prev_close::DOUBLE AS prev_close, mom_20, atr_14, rsi_14, prior_high::DOUBLE AS prior_high FROM features")
def corrected_features(spark, sf_dir):
    """Features of the bars as they were, in a store by month, corrected to those of the bars as they are."""
    old, now, changed = _corrected(spark, sf_dir)
    folder = new_folder(spark, "features")
    month = F.trunc("trade_date", "month")
    indicators.with_features(old).select("symbol", "trade_date", *corrections.FEATURES, month.alias("month")).repartition("month").write.partitionBy("month").parquet(folder)
    found = corrections.corrected_features(spark.read.parquet(folder), now, changed)
    return doubles(found, "prev_close", "prior_high")





@query(f"WITH {LABELS_SQL.format(gap=GAP)} SELECT trade_date, symbol, strategy, label, exit_price, ambiguous FROM labels")
def corrected_labels(spark, sf_dir):
    """Signals and labels of the bars as they were, with the days that a change can reach replaced; ranks are of whole days."""
    old, now, changed = _corrected(spark, sf_dir)

    def labelled(rows, dates=None):
        features = indicators.with_features(labels.with_bar(rows))
        found = risk.priced(features, labels.BAR, gap=GAP)
        if dates is not None:
            found = found.join(dates, "trade_date", "left_semi")
        return labels.outcomes(doubles(found, "entry_price")).select("trade_date", "symbol", "strategy", "label", "exit_price", "ambiguous")

    before, dates = staged(labelled(old), "labels"), staged(corrections.corrected_dates(changed, now), "dates")
    near = corrections.since(now, dates)
    return corrections.replaced_dates(before, labelled(near, dates), dates)


# merges

_KEYS = ["trade_date", "symbol"]


@query(
    f"""WITH {BARS_SQL} SELECT symbol, trade_date, CASE WHEN trades > 1 AND strftime(trade_date, '%Y-%m') IN ('1996-05', '1998-02') THEN open ELSE close END::DOUBLE AS price FROM bars
    UNION ALL SELECT 'N' || symbol, trade_date, low::DOUBLE FROM bars WHERE strftime(trade_date, '%Y-%m') = '1998-02' AND trades > 1"""
)
def merge_touched(spark, sf_dir):
    """Corrections of two months and new symbols, merged into a table of many files; only files of these keys are read and rewritten."""
    rows = doubles(bars(spark, sf_dir), "open", "low", "close").withColumn("month", F.date_format("trade_date", "yyyy-MM"))
    rows = staged(rows.select("symbol", "trade_date", "month", "open", "low", "close", "trades"), "bars")  # read for the table and for what is merged
    folder = new_folder(spark, "merged")
    manifest.create(rows.select("symbol", "trade_date", "month", F.col("close").alias("price")), folder, "month", _KEYS, 2000)
    late = rows.where("trades > 1 and month in ('1996-05', '1998-02')")
    new = late.select("symbol", "trade_date", "month", F.col("open").alias("price"), F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    new = new.withColumn("price", F.when(F.col("version") == 2, F.col("price")).otherwise(F.lit(-1.0)))  # every key twice, the second one counts
    added = late.where("month = '1998-02'").select(F.concat(F.lit("N"), "symbol").alias("symbol"), "trade_date", "month", F.col("low").alias("price"), F.lit(1).alias("version"))
    manifest.merge(staged(new.unionByName(added), "late"), folder, "month", _KEYS, ("version",), 2000)
    return manifest.read(spark, folder).select("symbol", "trade_date", "price")


# series that are too long for a task


@query(f"""WITH {CANDLES_SQL} SELECT ts, sum(high + low + close) OVER w::DOUBLE / (count(*) OVER w * 3) AS vwap_equal, sum((high + low + close) * volume) OVER w::DOUBLE / nullif(sum(volume) OVER w * 3, 0)::DOUBLE AS vwap_volume FROM candles WINDOW w AS (ORDER BY ts)""")
def running_vwap(spark, sf_dir):
    """VWAP from the first candle of all on, across sessions, in two passes over chunks of time."""
    three = exact(F.col("high") + F.col("low") + F.col("close"))
    rows = segments.running(candles(spark, sf_dir), [], {"price": three, "worth": three * F.col("volume"), "shares": F.col("volume"), "n": F.lit(1)})
    return rows.select("ts", (F.col("price").cast("double") / (F.col("n") * 3)).alias("vwap_equal"), ratio(F.col("worth"), F.col("shares") * 3).alias("vwap_volume"))


@query(
    f"""WITH {BARS_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS nth FROM bars), hit AS (
      SELECT a.symbol, a.trade_date, min(b.nth) - any_value(a.nth) AS days FROM placed a JOIN placed b ON a.symbol = b.symbol AND b.nth > a.nth AND (b.high >= a.close * 1.8::DECIMAL(10,4) OR b.low <= a.close * 0.1::DECIMAL(10,4)) WHERE a.close > 0 GROUP BY a.symbol, a.trade_date)
    SELECT p.symbol, p.trade_date, h.days FROM placed p LEFT JOIN hit h ON h.symbol = p.symbol AND h.trade_date = p.trade_date"""
)
def days_to_any_barrier(spark, sf_dir):
    """How many bars ahead a barrier is, however far; series are cut in chunks of a year."""
    return hold.with_barrier(bars(spark, sf_dir).select("symbol", "trade_date", "high", "low", "close"), 0.8, 0.9, None, "365 days").select("symbol", "trade_date", "days")


# rules as data


@query(
    f"""WITH {SELECTION_SQL}, long AS (SELECT trade_date, 'conversion_rate' AS metric, conversion_rate AS value FROM daily UNION ALL SELECT trade_date, 'failure_rate', failure_rate FROM daily UNION ALL SELECT trade_date, 'missed_opportunity_rate', missed_opportunity_rate FROM daily),
    rules(metric, nth, how, bound, label) AS (VALUES {", ".join(str(x) for x in RULES)}),
    met AS (SELECT l.trade_date, l.metric, min(r.nth) AS nth FROM long l JOIN rules r ON r.metric = l.metric AND CASE r.how WHEN 'lt' THEN l.value < r.bound WHEN 'lte' THEN l.value <= r.bound WHEN 'gt' THEN l.value > r.bound WHEN 'gte' THEN l.value >= r.bound END GROUP BY 1, 2)
    SELECT l.trade_date, l.metric, l.value, r.label FROM long l LEFT JOIN met m ON m.trade_date = l.trade_date AND m.metric = l.metric LEFT JOIN rules r ON r.metric = m.metric AND r.nth = m.nth"""
)
def rules_applied(spark, sf_dir):
    """Every day's rates under rules that are rows of a frame: the first that fits counts."""
    table_of_rules = spark.createDataFrame([(*x, None) for x in RULES], "metric string, nth int, how string, bound double, label string, sentence string")
    daily = selection.summary(classified(spark, sf_dir))
    return rules.applied(rules.unpivoted(daily, ["trade_date"], ["conversion_rate", "failure_rate", "missed_opportunity_rate"]), table_of_rules, ["trade_date"]).select("trade_date", "metric", "value", "label")


# sinks, written and read back


@query(
    f"""WITH {BARS_SQL} SELECT symbol, trade_date, close::DOUBLE AS close FROM bars WHERE year(trade_date) = 1997
    UNION ALL SELECT symbol, trade_date, close::DOUBLE FROM bars WHERE year(trade_date) = 1997 AND trades > 1"""
)
def sink_append(spark, sf_dir):
    """Two batches added; of the second only the columns that the target knows."""
    rows, path = doubles(bars(spark, sf_dir), "close").where("year(trade_date) = 1997").select("symbol", "trade_date", "close", "trades"), new_folder(spark, "appended")
    store.append(rows.drop("trades"), path)
    store.append(rows.where("trades > 1"), path, ["symbol", "trade_date", "close"])
    return spark.read.parquet(path)


@query(
    f"""WITH {BARS_SQL}, corrected AS (SELECT DISTINCT trade_date AS d FROM bars WHERE year(trade_date) = 1997 AND day(trade_date) = 5 AND trades = 1)
    SELECT symbol, trade_date, CASE WHEN d IS NULL THEN close ELSE open END::DOUBLE AS price FROM bars LEFT JOIN corrected ON d = trade_date WHERE year(trade_date) = 1997 AND (d IS NULL OR trades = 1)"""
)
def sink_dates(spark, sf_dir):
    """Dates replaced whole: rows of the day that the new ones lack are gone, other days stay; running it twice changes nothing."""
    rows, path = doubles(bars(spark, sf_dir), "open", "close").where("year(trade_date) = 1997"), new_folder(spark, "dates")
    store.write_dates(rows.select("symbol", F.col("close").alias("price"), "trade_date"), path)
    new = rows.where("day(trade_date) = 5 and trades = 1").select("symbol", F.col("open").alias("price"), "trade_date")
    for _ in range(2):
        store.write_dates(new, path, files=2)
    return spark.read.parquet(path).select("symbol", "trade_date", "price")


@query(f"WITH {BARS_SQL} SELECT symbol, trade_date, high::DOUBLE AS price, 2 AS version FROM bars WHERE year(trade_date) = 1997")
def sink_snapshot(spark, sf_dir):
    """A snapshot, and a second one that readers see once the pointer names it."""
    rows, path = doubles(bars(spark, sf_dir), "high", "low").where("year(trade_date) = 1997"), new_folder(spark, "snapshots")
    for version, price in ((1, "low"), (2, "high")):
        store.write_snapshot(rows.select("symbol", "trade_date", F.col(price).alias("price"), F.lit(version).alias("version")), path)
    return store.read_snapshot(spark, path)


@query(f"WITH {BARS_SQL}, days AS (SELECT symbol, trade_date, row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS nth FROM bars) SELECT symbol, trade_date FROM days WHERE nth = 1")
def sink_log(spark, sf_dir):
    """Status of each symbol's days as JSON lines, added in two runs; the last line of a symbol counts."""
    rows, path = bars(spark, sf_dir).select("symbol", "trade_date"), new_folder(spark, "log")
    for odd in (0, 1):
        store.write_log(rows.where(F.pmod(F.unix_date("trade_date"), F.lit(2)) == odd), path)
    return store.last_of(spark.read.schema("symbol string, trade_date date").json(path), ["symbol"], ("trade_date",))


@query("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN NULL ELSE o_orderdate::DATE END AS day FROM orders")
def flexible_dates(spark, sf_dir):
    """Dates in every form that is read, with blanks around them, and in one that isn't."""
    forms = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy", "dd-MMM-yyyy", "'day' yyyyMMdd")
    kind, text = F.col("o_orderkey") % 6, F.lit(None).cast("string")
    for k, form in enumerate(forms):
        text = F.when(kind == k, F.date_format("o_orderdate", form)).otherwise(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", names.loose_date(F.concat(F.lit(" "), text, F.lit(" "))).alias("day"))


@query("SELECT o_custkey, max(o_orderdate::DATE) AS day FROM orders GROUP BY o_custkey")
def newest_files(spark, sf_dir):
    """The newest of each customer's files by the date in its name."""
    files = table(spark, sf_dir, "orders").select("o_custkey", F.concat(F.lit("/x/PR"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".zip")).alias("path"), F.lit("2025-10-03 18:00:00").cast("timestamp").alias("modificationTime"))
    found = archive.newest_of(files, ["o_custkey"])
    return found.select("o_custkey", names.file_date(F.regexp_extract("path", r"([^/]*)$", 1)).alias("day")).distinct()
