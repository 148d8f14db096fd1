"""Edges worked out by hand: nulls, ties, zero denominators, minimum rows."""

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quotemill.functions import coerce, names
from quotemill.operators import candidates, hold, indicators, instruments, labels, liquidity, ranks, risk, scans, selection, sessions, signals, trading_days
from quotemill.sources import standin, store

D0 = dt.date(2025, 1, 1)
BAR = "symbol string, trade_date date, open decimal(18,2), high decimal(18,2), low decimal(18,2), close decimal(18,2), net_trdval decimal(24,2), net_trdqty long, trades long, mkt_flag int, ind_sec string"


def bars(spark, rows):
    """rows: (day, open, high, low, close)."""
    from decimal import Decimal

    num = lambda x: None if x is None else Decimal(str(x))
    data = [("A", D0 + dt.timedelta(days=d), num(o), num(h), num(low), num(c), num(1000), 10, 5, 0, "N") for d, o, h, low, c in rows]
    return spark.createDataFrame(data, BAR).withColumn("day", F.unix_date("trade_date"))


def last(df, col):
    return df.orderBy(F.desc("trade_date")).first()[col]


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


def test_atr_needs_its_rows(spark):
    flat = lambda n: bars(spark, [(k, 10, 11, 9, 10) for k in range(n)])
    assert last(indicators.with_features(flat(13)), "atr_14") is None
    assert last(indicators.with_features(flat(14)), "atr_14") == 2.0


def test_momentum_and_rsi_minimum_rows(spark):
    rising = lambda n: indicators.with_features(bars(spark, [(k, 100 + k, 101 + k, 99 + k, 100 + k * 10 / (n - 1)) for k in range(n)]))
    assert last(rising(20), "mom_20") is None
    assert last(rising(21), "mom_20") == pytest.approx(10)
    zigzag = lambda n: indicators.with_features(bars(spark, [(k, 10, 11, 9, 10 + k % 2) for k in range(n)]))
    assert last(zigzag(14), "rsi_14") is None and 0 <= last(zigzag(15), "rsi_14") <= 100
    assert last(rising(15), "rsi_14") is None  # no losses
    w = indicators.series()
    up = bars(spark, [(k, 10, 11, 9, 10 + k) for k in range(15)]).withColumn("rsi", indicators.rsi_epsilon(F.col("close"), w))
    assert last(up, "rsi") == pytest.approx(100, abs=1e-4)


def test_missing_closes_are_carried_into_momentum(spark):
    rows = [(k, 1, 2, 1, 100 + k) for k in range(22)]
    rows[21] = (21, 1, 2, 1, None)
    got = indicators.with_features(bars(spark, rows))
    assert last(got, "mom_20") == pytest.approx((120 / 101 - 1) * 100)


def test_three_true_ranges(spark):
    df = spark.createDataFrame([(12.0, 10.0, None), (None, 10.0, 11.0), (12.0, 10.0, 13.0)], "h double, l double, pc double").select(*[F.col(c).cast("decimal(18,4)") for c in ("h", "l", "pc")])
    a = [F.col(c) for c in ("h", "l", "pc")]
    got = df.select(indicators.range_zero_fill(*a), indicators.range_skip_null(*a), indicators.range_propagate_null(*a)).collect()
    assert [tuple(None if x is None else float(x) for x in r) for r in got] == [(2, 2, None), (1, 1, None), (3, 3, 3)]


def test_gap_bounds_are_included_and_zero_is_no_signal(spark):
    rows = [(0, 100, 100, 100, 100), (1, 102, 103, 100, 100), (2, 98, 99, 97, 100), (3, 101.9, 102, 100, 0), (4, 50, 51, 49, 50)]
    got = signals.gap_signals(indicators.with_features(bars(spark, rows))).orderBy("trade_date").collect()
    assert [(r["trade_date"].day, r["signal_type"]) for r in got] == [(2, "LONG"), (3, "SHORT")]


def test_breakout_is_strict_and_twenty_days_are_calendar_days(spark):
    rows = [(k, 10, 11, 9, 10) for k in range(20)] + [(20, 11, 11, 10, 11), (21, 11, 12, 10, 11.5)]
    got = signals.breakout_signals(indicators.with_features(bars(spark, rows))).collect()
    assert [r["trade_date"] for r in got] == [D0 + dt.timedelta(days=21)]
    far = indicators.with_features(bars(spark, [(0, 1, 50, 1, 1), (20, 1, 2, 1, 1), (21, 1, 3, 1, 1)]))
    assert [None if r["prior_high"] is None else float(r["prior_high"]) for r in far.orderBy("day").collect()] == [None, 50.0, 2.0]


def test_stops_and_targets(spark):
    f = spark.createDataFrame([("A", D0, 2.0, 100.0), ("B", D0, None, None)], "symbol string, trade_date date, atr_14 double, prev_close double")
    rows = [("A", D0, "momentum", "LONG", 100.0, None, None), ("A", D0, "momentum", "SHORT", 100.0, None, None), ("B", D0, "momentum", "LONG", 100.0, 0.0, None), ("A", D0, "gap", "LONG", 104.0, None, None), ("A", D0, "momentum", "LONG", 100.0, 95.0, None), ("A", D0, "breakout", "LONG", 100.0, None, None)]
    df = spark.createDataFrame(rows, "symbol string, trade_date date, strategy string, signal_type string, e double, stop_price double, target_price double").withColumn("entry_price", F.col("e").cast("decimal(18,2)"))
    got = [(r["stop_price"], r["target_price"], r["stop_imputed"]) for r in risk.with_risk(df.coalesce(1), f).orderBy("symbol", "strategy", F.desc("signal_type"), F.desc_nulls_first("stop_price")).collect()]
    assert sorted(got, key=str) == sorted([(97.0, 106.0, True), (103.0, 94.0, True), (99.5, 101.0, True), (97.0, 110.0, True), (95.0, 106.0, False), (None, None, False)], key=str)


def test_entry_falls_back_to_the_close(spark):
    b = bars(spark, [(0, 1, 2, 1, 101), (1, 55, 60, 50, 58), (3, 7, 8, 6, 7)])
    s = spark.createDataFrame([("A", D0, "next_open", None), ("A", D0 + dt.timedelta(days=1), "", None), ("A", D0 + dt.timedelta(days=3), "open", None), ("Z", D0, "open", None)], "symbol string, trade_date date, entry_model string, entry_price double")
    got = {(r["symbol"], r["trade_date"].day): (None if r["entry_price"] is None else float(r["entry_price"]), r["entry_source"]) for r in risk.with_entries(s, b).collect()}
    assert got == {("A", 1): (55.0, "entry_open"), ("A", 2): (58.0, "trade_close_fallback"), ("A", 4): (7.0, "entry_open"), ("Z", 1): (None, None)}


@pytest.mark.parametrize(
    "side, prices, bar, want",
    [
        ("LONG", (100, 95, 110), (111, 99, 108), ("win", 110, 0, 10)),
        ("LONG", (100, 95, 110), (105, 94, 96), ("loss", 95, 0, -5)),
        ("LONG", (100, 95, 110), (112, 90, 100), ("neutral", None, 1, None)),
        ("LONG", (100, 95, 110), (105, 97, 103), ("neutral", 103, 0, 3)),
        ("SHORT", (100, 105, 90), (101, 89, 92), ("win", 90, 0, 10)),
        (None, (100, None, 90), (101, 89, 92), ("win", 90, 0, 10)),
        ("LONG", (100, 95, 110), None, ("neutral", None, 0, None)),
    ],
)
def test_labels(spark, side, prices, bar, want):
    b = bars(spark, [(0, 100, *bar)]) if bar else bars(spark, [(5, 1, 1, 1, 1)])
    entry, stop, target = (None if p is None else float(p) for p in prices)
    s = spark.createDataFrame([("A", D0, "m", side, entry, stop, target)], "symbol string, trade_date date, strategy string, signal_type string, entry_price double, stop_price double, target_price double")
    r = labels.label_outcomes(s, b).first()
    assert (r["label"], r["exit_price"], r["ambiguous"]) == want[:3]
    assert r["realized_return"] == (pytest.approx(want[3]) if want[3] is not None else None)
    assert r["note"] == labels.NO_BAR or bar


def test_rank_share_averages_ties(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 2.0), (1, None), (1, 5.0)], "d int, v double")
    found = ranks.ranked(df, "d", "v")
    assert sorted((r["v"], r["n"], r["r"]) for r in found.withColumn("r", ranks.rank_share()).collect()) == [(1.0, 1, 0.25), (2.0, 2, 0.625), (5.0, 1, 1.0)]
    assert [r["quantile"] for r in ranks.quantiles(found, "d", "v", 0.7).collect()] == [pytest.approx(2.3)]


def test_gates_without_average_value_never_pass_and_scores_of_nothing_are_zero(spark):
    m = liquidity.liquidity_metrics(bars(spark, [(0, 30, 30, 30, 30)]))
    assert liquidity.with_gates(m).first()["hard_pass"] is False
    assert liquidity.gated(m, "enforce").count() == 0 and liquidity.gated(m).count() == 1
    s = spark.createDataFrame([("Q", D0, 0.0)], "symbol string, trade_date date, signal_score double")
    assert liquidity.combined_score(s, m).first()["combined_score"] == 0.0
    keep = spark.createDataFrame([(0,), (10,), (1000,), (20,)], "n int").select(liquidity.suggested_keep(F.col("n"), F.lit(5.0))).collect()
    assert [r[0] for r in keep] == [0.3, 0.5, 0.05, 0.25]


def test_hold_days(spark):
    rows = [(k, 10, 10, 10, 10) for k in range(12)]
    assert hold.empirical_hold(bars(spark, rows)).first()["days"] is None  # nothing is hit
    rows = [(k, 10, 10 + k, 10, 10) for k in range(12)]
    r = hold.empirical_hold(bars(spark, rows)).first()
    assert (r["samples"], r["days"]) == (11, 1)
    assert hold.empirical_hold(bars(spark, rows[:9])).first()["days"] is None
    df = spark.createDataFrame([(2.0, 0.0), (None, 5.0), (0.0, 100.0)], "atr double, score double")
    assert [tuple(x) for x in df.select(hold.atr_hold(F.col("atr")), hold.score_hold(F.col("score"))).collect()] == [(3, 7), (None, 4), (None, 3)]


def test_names_numbers_and_dates(spark):
    assert one(spark, "Alpha Foods (New) Ltd.", names.name_key) == "ALPHA FOODS"
    assert one(spark, "North Indian Oil Limited", names.name_key) == "NORTH N OIL"
    assert one(spark, None, names.name_key) == ""
    assert one(spark, " alpha  (x) Ltd. ", names.light_key) == "ALPHA LTD."
    assert [one(spark, t, coerce.number_text) for t in (" 1,234.5% ", "", "-", None, "NaN")] == [1234.5, None, None, None, None]
    for name in ("PR031025.csv", "x20251003.csv", "x03102025.csv"):
        assert one(spark, name, names.file_date) == dt.date(2025, 10, 3)
    assert one(spark, "x311299.csv", names.file_date) == dt.date(1999, 12, 31) and one(spark, "x010130.csv", names.file_date) == dt.date(2030, 1, 1)
    assert one(spark, "x123125.csv", names.file_date) == dt.date(2025, 12, 31) and one(spark, "none.csv", names.file_date) is None
    assert one(spark, "03-10-2025", names.loose_date) == dt.date(2025, 10, 3)
    assert [one(spark, t, coerce.canonical_json) for t in ('{"a": 1}', "plain", "", None, "{broken")] == ['{"a":1}', '"plain"', None, None, '"{broken"']
    assert [one(spark, t, coerce.scalar_json) for t in ("1,234", "1.5", "nan", "x", None)] == ["1234", "1.5", "null", '"x"', "null"]
    assert one(spark, " y ", coerce.market_flag) == 1 and one(spark, "N", coerce.market_flag) == 0


def test_candidates(spark):
    d = str(D0)
    gl = spark.createDataFrame([(d, f"S{k}", 1.9 - k / 1000, k) for k in range(60)] + [(d, "S0", 2.5, 60), (d, "T", None, 61)], "trade_date string, security string, pct double, row_seq long")
    got = candidates.movers(gl).collect()
    assert len(got) == len({r["security"] for r in got}) == 49
    assert [r["pct"] for r in got if r["security"] == "S0"] == [2.5]
    parts = [(d, "A", "top_turnover", 0, None, None, None, 9.0, None), (d, "A", "gainer_loser", 5, 3.0, 1.0, 2.0, None, None), (d, "A", "gainer_loser", 7, 4.0, None, None, None, None), (d, "A", "circuit", 1, None, None, None, None, "H"), (d, "A", "circuit", 2, None, None, None, None, "L")]
    r = candidates.merged(spark.createDataFrame(parts, "trade_date string, symbol string, reason string, row_seq long, pct double, last_price double, prev_close double, turnover double, status string")).first()
    assert (r["reason_set"], r["primary_reason"], r["pct"], r["last_price"], r["turnover"], r["status"]) == ("circuit,gainer_loser,top_turnover", "circuit", 3.0, 1.0, 9.0, "L")
    pd = spark.createDataFrame([("Acme Ltd", "AC1", 0), ("ACME LIMITED", "AC2", 1), ("", "X", 2)], "security string, symbol string, row_seq long")
    got = candidates.mapped(spark.createDataFrame([("acme",), ("Zed Pvt",)], "security string"), pd).collect()
    assert {r["symbol"] for r in got} == {"AC1", "ZED"}
    none = spark.createDataFrame([], "symbol string")
    assert candidates.in_master(pd, none).count() == 3
    assert candidates.in_master(pd, spark.createDataFrame([(" ac2 ",)], "symbol string")).count() == 1


def test_instruments(spark):
    rows = spark.createDataFrame([("A", "EQ", "N", 1), ("A", "EQ", "N", 2), (" ", "EQ", "N", 3), ("E", "EQ", "N", 4)], "SYMBOL string, Series string, MKT string, row_seq long").withColumn("source_file", F.lit("f"))
    st = instruments.staged_rows(rows, ("symbol",), ("series",), ("mkt",), spark.createDataFrame([("e",)], "symbol string"))
    assert {(r["symbol_raw"], r["is_etf"], r["row_seq"]) for r in st.collect()} == {("A", False, 1), ("E", True, 4)}
    assert [r["symbol_raw"] for r in instruments.eligible(st).collect()] == ["A"]
    v = instruments.validated(st.withColumn("symbol_raw", F.when(F.col("symbol_raw") == "E", F.lit(None)).otherwise(F.col("symbol_raw"))))
    assert {(r["is_valid"], r["errors"]) for r in v.collect()} == {(True, ""), (False, "no_symbol_resolved")}
    new = spark.createDataFrame([("A", "EQ", None), ("B", "BE", "x"), ("C", "EQ", "y"), (" ", "EQ", "z")], "symbol string, series string, notes string")
    old = spark.createDataFrame([("A", "EQ", None), ("B", "EQ", None)], "symbol string, series string, notes string")
    got = {r["symbol"]: (r["action"], r["diff"]) for r in instruments.changes(new, old, ("series", "notes")).collect()}
    assert got == {"A": ("no_change", ""), "B": ("updated", "notes:null>x;series:EQ>BE"), "C": ("inserted", ""), " ": ("skipped_no_symbol", "")}
    day = lambda k: D0 + dt.timedelta(days=k)
    dates = spark.createDataFrame([(day(10),), (day(500),), (day(5000),)], "trade_date date")
    contracts = spark.createDataFrame([(day(9), 1, "a"), (day(10), 5, "b"), (day(10), 3, "c"), (day(40), 2, "d"), (day(1500), 7, "e")], "expiry date, token long, tradingsymbol string")
    got = {r["trade_date"]: r["token"] for r in instruments.nearest_contract(dates, contracts).collect()}
    assert got == {day(10): 3, day(500): 7}
    t = spark.createDataFrame([("A", 1, None), ("A", 2, 5), ("B", 1, 1), ("B", 1, 2)], "k string, a int, b int")
    assert {(r["k"], r["a"], r["b"]) for r in instruments.keep_latest(t, ["k"], "b", "a").collect()} == {("A", 1, None), ("B", 1, 2)}


CANDLE = "session string, ts timestamp, open double, high double, low double, close double, volume long"


def candles(spark, rows):
    base = dt.datetime(2025, 1, 1, 9, 15)
    df = spark.createDataFrame([(s, base + dt.timedelta(minutes=5 * k), float(o), float(h), float(low), float(c), v) for k, (s, o, h, low, c, v) in enumerate(rows)], CANDLE)
    return df.select("session", "ts", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("open", "high", "low", "close")], "volume")


def test_sessions(spark):
    flat = candles(spark, [("a", 5, 5, 5, 5, 1)] * 3)
    r = sessions.session_summary(flat).first()
    assert (r["trend_strength"], r["pullback_depth"], r["vwap_cross_count"], r["candles"]) == (0.0, 0.0, 0, 3)
    up = candles(spark, [("a", 1, 3, 1, 2, 0), ("a", 2, 4, 2, 3, 2), ("b", 1, 4, 2, 3, 1), ("b", 1, 3, 1, 2, 1), ("c", 2, 4, 2, 3, 1), ("c", 2, 3, 2.5, 3, 1)])
    got = {r["session"]: (r["structure"], r["gap_hold"]) for r in sessions.structure(up).collect()}
    assert got == {"a": ("LONG_VALID", None), "b": ("SHORT_VALID", "NO"), "c": ("INVALID", "NO_GAP")}
    assert sessions.with_vwap(up).orderBy("ts").first()["vwap_volume"] is None
    o = sessions.stock_outcome(bars(spark, [(0, 100, 101.5, 98, 100), (1, 100, 101, 99, 100), (2, 100, 101, 99.5, 100), (3, 0, 1, 0, 1)])).orderBy("trade_date").collect()
    assert [r["outcome"] for r in o] == ["SUCCESS", "FAILURE", "CHOP", None]


def test_candle_normalising(spark):
    rows = [("1735689600", "1", "2", "1", "1", "10"), ("1735689600000", "1", "2", "1", "1", "10"), ("2025-01-01 00:00:00", "1", "2", "1", "1", "10"), ("2025-01-01T00:00:00Z", "1", "2", "1", "1", "10"), ("2025-01-01", "1", "1", "2", "1", "10"), ("2025-01-01", "NaN", "1", "1", "1", "10"), (None, "1", "1", "1", "1", "1"), ("2025-01-01", "1", "1", "1", "1", None)]
    got = sessions.normal_candles(spark.createDataFrame(rows, "timestamp string, open string, high string, low string, close string, volume string")).collect()
    assert [r["reason"] for r in got] == [None, None, None, None, "low exceeds high", "open", "timestamp", "volume"]
    assert {r["ts"] for r in got[:4]} == {dt.datetime(2025, 1, 1, 5, 30)}


def test_selection_quality(spark):
    c = spark.createDataFrame([(D0, s, sel) for s, sel in (("a", True), ("b", True), ("c", True), ("d", True), ("e", False), ("f", False), ("g", False))], "trade_date date, symbol string, selected boolean")
    o = spark.createDataFrame([(D0, s, x) for s, x in (("a", "SUCCESS"), ("b", "FAILURE"), ("c", "CHOP"), ("e", "SUCCESS"), ("f", "FAILURE"))], "trade_date date, symbol string, outcome string")
    k = selection.classes(c, o)
    assert {r["symbol"]: r["classification"] for r in k.collect()} == {"a": "GOOD_SELECTION", "b": "BAD_SELECTION", "c": "CHOP", "d": "CHOP", "e": "MISSED_OPPORTUNITY", "f": "CORRECT_REJECTION", "g": "CORRECT_REJECTION"}
    assert {r["symbol"] for r in selection.data_gaps(k).collect()} == {"d", "g"} and selection.diagnostics(k).count() == 5
    none = selection.summary(selection.classes(c.withColumn("selected", F.lit(False)), o))
    assert none.first()["conversion_rate"] == 0.0
    s = {r["rule_name"]: r["priority"] for r in selection.suggestions(none).collect()}
    assert s == {"conversion_rate": "HIGH"}
    text = selection.summary_text(none).first()
    assert text["conversion_rate_label"] == "LOW_CONVERSION" and text["summary_text"].endswith("1 improvement opportunities identified.")
    exact = none.withColumn("conversion_rate", F.lit(0.4)).withColumn("missed_opportunity_rate", F.lit(0.3))
    assert selection.suggestions(exact).count() == 0 and selection.summary_text(exact).first()["conversion_rate_label"] == "GOOD_CONVERSION"
    day = lambda k: spark.createDataFrame([(D0,)] if k else [], "trade_date date")
    count = lambda n: spark.createDataFrame([(D0, n)], "trade_date date, candles long")
    status = lambda a, b, cc, n: selection.validation(day(1), day(a), day(b), day(cc), count(n)).first()["validation"]
    assert [status(1, 1, 1, 75), status(0, 1, 1, 75), status(1, 1, 1, 74), status(1, 1, 0, 80)] == ["COMPLETE", "PARTIAL", "SKIPPED", "SKIPPED"]


def test_trading_days(spark):
    day = lambda k: D0 + dt.timedelta(days=k)
    b = spark.createDataFrame([(day(k),) for k in (3, 4, 20)], "trade_date date")
    asked = spark.createDataFrame([(day(k),) for k in (0, 3, 5, 15, 30)] + [(None,)], "asked date")
    got = {r["asked"]: r["trade_date"] for r in trading_days.resolved(asked, b).collect()}
    assert got == {day(0): None, day(3): day(3), day(5): day(4), day(15): day(4), day(30): day(20), None: day(20)}
    jobs = spark.createDataFrame([(day(3), "FAILED"), (day(4), "PARTIAL")], "trade_date date, status string")
    assert [r["trade_date"] for r in trading_days.pending(b, jobs).collect()] == [day(3), day(20)]
    cal = {str(r["trade_date"]): r for r in trading_days.calendar(spark, "2026-01-24", "2026-01-26").collect()}
    assert cal["2026-01-25"]["last_weekday"] == dt.date(2026, 1, 23) and not cal["2026-01-26"]["is_open"]


def test_stores(spark, tmp_path):
    old = spark.createDataFrame([(1, 95.0, 1.0), (2, 90.0, 1.0)], "k int, stop double, score double")
    new = spark.createDataFrame([(1, None, 2.0), (3, 7.0, 3.0)], "k int, stop double, score double")
    assert {tuple(r) for r in store.coalesced(old, new, ["k"], ("stop",)).collect()} == {(1, 95.0, 2.0), (2, 90.0, 1.0), (3, 7.0, 3.0)}
    assert {tuple(r) for r in store.replaced(old, new, ["k"]).collect()} == {(1, None, 2.0), (2, 90.0, 1.0), (3, 7.0, 3.0)}
    assert {r["k"] for r in store.absent(old, new, ["k"]).collect()} == {3}
    assert {tuple(r) for r in store.updated(old, new, ["k"], ("score",)).collect()} == {(1, 95.0, 2.0), (2, 90.0, 1.0)}
    root = str(tmp_path / "t")
    store.write_snapshot(old, root)
    store.write_snapshot(store.replaced(store.read_snapshot(spark, root), new, ["k"]), root)
    assert store.read_snapshot(spark, root).count() == 3
    days = spark.createDataFrame([(D0, 1), (D0 + dt.timedelta(days=1), 2)], "trade_date date, v int")
    for _ in range(2):
        store.write_dates(days, f"{root}-d")
        store.write_dates(days.where("v = 2").withColumn("v", F.lit(9)), f"{root}-d")
    assert sorted(r["v"] for r in spark.read.parquet(f"{root}-d").collect()) == [1, 9]
    store.append(days, f"{root}-a", ["v", "missing"])
    assert spark.read.parquet(f"{root}-a").columns == ["v"]


def test_repeated_keys_in_an_upsert_leave_one_row_a_key(spark):
    old = spark.createDataFrame([(1, 10.0, 1.0), (2, 20.0, 2.0)], "k int, stop double, score double")
    new = spark.createDataFrame([(1, None, 5.0, 2), (1, 3.0, 4.0, 1), (3, 7.0, 1.0, 1), (3, 8.0, 2.0, 2)], "k int, stop double, score double, seq int")
    assert sorted(map(tuple, store.replaced(old, new, ["k"], ("seq",)).collect()), key=str) == [(1, None, 5.0), (2, 20.0, 2.0), (3, 8.0, 2.0)]
    assert sorted(map(tuple, store.coalesced(old, new, ["k"], ("stop",), ("seq",)).collect())) == [(1, 10.0, 5.0), (2, 20.0, 2.0), (3, 8.0, 2.0)]
    assert sorted(map(tuple, store.updated(old, new, ["k"], ("score",), ("seq",)).collect())) == [(1, 10.0, 5.0), (2, 20.0, 2.0)]


def test_a_member_that_a_form_cannot_read_gives_its_rows_once(spark):
    import csv
    import io
    import zipfile

    from quotemill.sources import archive

    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        z.writestr("PR031025.csv", "SECURITY,CLOSE\na,1\nb,2\nc,\"" + "x" * (csv.field_size_limit() + 10) + "\"\n")
        z.writestr("GL031025.csv", "SECURITY;CLOSE\na;1\nb;2\n")
    files = spark.createDataFrame([("/in/PR031025.zip", dt.datetime(2025, 10, 3), bytearray(made.getvalue())), ("/in/none.zip", dt.datetime(2025, 10, 4), bytearray(b"no archive"))], "path string, modificationTime timestamp, content binary")
    rows = archive.member_rows(files, sniff=True).collect()
    assert [(r["kind"], r["row_seq"], r["fields"]["SECURITY"]) for r in rows if r["kind"] == "GL"] == [("GL", 0, "a"), ("GL", 1, "b")]
    assert len([r for r in rows if r["kind"] == "PR"]) in (0, 2)
    more = files.unionByName(spark.createDataFrame([("/in/PR021025.zip", dt.datetime(2026, 1, 1), bytearray(b""))], files.schema))
    assert archive.newest(more).first()["path"] == "/in/PR031025.zip"


def test_times_without_a_zone_are_utc_in_any_session(spark):
    rows = [("2025-10-03 04:00:00", "1", "1", "1", "1", "2"), ("2025-10-03T04:00:00+02:00", "1", "1", "1", "1", "2"), ("1759464000", "1", "1", "1", "1", "2"), ("2025-10-03", "1", "1", "1", "1", "2")]
    df = spark.createDataFrame(rows, "timestamp string, open string, high string, low string, close string, volume string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = [r["ts"] for r in sessions.normal_candles(df).collect()]
            assert got == [dt.datetime(2025, 10, 3, 9, 30), dt.datetime(2025, 10, 3, 7, 30), dt.datetime(2025, 10, 3, 9, 30), dt.datetime(2025, 10, 3, 5, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sessions_of_instruments_stay_apart(spark):
    base = dt.datetime(2025, 10, 3, 9, 15)
    rows = [(s, "d1", base + dt.timedelta(minutes=5 * k), p + k, p + k + 1, p + k - 1, p + k + 0.5, 10) for s, p in (("A", 100.0), ("B", 500.0)) for k in range(4)]
    rows += [("A", "d2", base + dt.timedelta(days=1), 90.0, 91.0, 89.0, 90.5, 10)]
    df = spark.createDataFrame(rows, "symbol string, session string, ts timestamp, open double, high double, low double, close double, volume long")
    got = {(r["symbol"], r["session"]): r for r in sessions.session_summary(df).collect()}
    assert {k: v["total_range"] for k, v in got.items()} == {("A", "d1"): 5.0, ("B", "d1"): 5.0, ("A", "d2"): 2.0}
    for symbol in ("A", "B"):
        own = sessions.session_summary(df.where(F.col("symbol") == symbol).drop("symbol")).orderBy("session").collect()
        assert [tuple(r)[1:] for r in own] == [tuple(v)[2:] for k, v in sorted(got.items()) if k[0] == symbol]
    gaps = {(r["symbol"], r["session"]): r["gap_hold"] for r in sessions.structure(df).collect()}
    assert gaps == {("A", "d1"): None, ("B", "d1"): None, ("A", "d2"): "YES"}


def test_interval_names_candle_columns_and_logs(spark, tmp_path):
    df = spark.createDataFrame([("5m",), (" 5Minute ",), ("15m",), (None,)], "i string")
    assert [r[0] for r in df.select(scans.five_minutes(F.col("i"))).collect()] == [True, True, False, False]
    rows = spark.createDataFrame([("1", "2", "0.5", "1.5", "1,200", "x")], "Open string, High string, Low string, Close string, Volume string, Other string")
    assert [tuple(r) for r in scans.candle_columns(rows).collect()] == [(1.0, 2.0, 0.5, 1.5, 1200.0)]
    with pytest.raises(ValueError, match="Volume"):
        scans.candle_columns(rows.drop("Volume"))
    for day in ("2025-10-03", "2025-10-04"):
        store.write_log(spark.createDataFrame([(day, "SELECTED")], "trade_date string, status string"), f"{tmp_path}/log")
    assert sorted(r["trade_date"] for r in spark.read.json(f"{tmp_path}/log").collect()) == ["2025-10-03", "2025-10-04"]


def test_dates_are_looked_at_up_to_the_first_that_is_ready(spark):
    dates = spark.createDataFrame([(dt.date(2025, 10, d),) for d in (1, 2, 3, 6)], "trade_date date")
    ready = dates.where("trade_date >= '2025-10-03'")
    log = [tuple(r)[1:4] for r in trading_days.resolution_log(dates, ready, dates.limit(0)).orderBy("trade_date").collect()]
    assert log == [(False, 0, "REJECTED"), (False, 0, "REJECTED"), (True, 0, "SELECTED")]
    assert trading_days.resolution_log(dates, ready.limit(0), dates).where("status = 'REJECTED'").count() == 4


def test_fields_of_odd_objects(spark):
    texts = ["{'a': 'x', 'SECURITY': ' y '}", '{"n": "12.5", "b": "long text"}', "no object", None, "[1]", '{"a": {"b": 1}}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(coerce.object_fields(F.col("t")).alias("m"), coerce.security_in(coerce.object_fields(F.col("t"))).alias("s"), coerce.with_member(F.col("t"), "l", F.lit('{"k":1}')).alias("p")).collect()
    assert [r["m"] for r in got] == [{"a": "x", "SECURITY": " y "}, {"n": "12.5", "b": "long text"}, {}, {}, {}, {"a": '{"b":1}'}]
    assert [r["s"] for r in got][:3] == ["y", "long text", None]
    assert [r["p"] for r in got] == ['{"l":{"k":1}}', '{"b":"long text","n":"12.5","l":{"k":1}}', '{"l":{"k":1}}', '{"l":{"k":1}}', '{"l":{"k":1}}', '{"a":{"b":1},"l":{"k":1}}']


def test_bars_are_dealt_by_symbol_once_in_tasks_of_so_many_rows(spark, monkeypatch):
    monkeypatch.setattr(standin, "PART_ROWS", 500)
    bars = standin.bars(spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert bars.rdd.getNumPartitions() == -(-rows // 500)
    plan = indicators.with_features(bars)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan


def test_empirical_hold_counts_bars_with_a_close_and_sends_only_what_is_searched(spark):
    rows = [(k, 10, 10 + k, 10, 0 if k < 3 else 10) for k in range(12)]
    assert hold.empirical_hold(bars(spark, rows)).first()["days"] is None  # 9 bars with a close above 0
    rows = [(k, 10, 10 + k, 10, 0 if k < 2 else 10) for k in range(12)]
    assert tuple(hold.empirical_hold(bars(spark, rows)).first())[1:] == (9, 1)
    assert hold.empirical_hold(bars(spark, [(0, 1, 1, 1, 0)])).count() == 0
    plan = hold.empirical_hold(bars(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    sent = plan.split("MapInArrow")[1].splitlines()
    assert all(c not in sent[0] + sent[1] for c in ("trade_date", "close#", "high#"))


def test_bars_by_number_are_the_named_ones_and_prices_stay_or_wrap(spark, tmp_path):
    day = dt.datetime(2024, 1, 2)
    lines = [(1, 1, 7, 1.0, 10.25, day), (1, 1, 7, 2.0, 9.5, day), (2, 1, 7, 1.0, -3.0, day), (3, 1, 9, 1.0, 2.5e12, day), (None, 1, 8, 1.0, 4.0, day), (4, 1, None, 1.0, 4.0, day), (5, 1, 6, 1.0, None, day)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    named, numbered = standin.bars(spark, str(tmp_path)), standin.bars(spark, str(tmp_path), named=False)
    assert dict(numbered.dtypes)["symbol"] == "bigint"
    want = sorted(named.collect(), key=str)
    assert sorted(numbered.withColumn("symbol", standin.symbol_of("symbol")).collect(), key=str) == want
    assert {r["symbol"]: (r["open"], r["close"]) for r in want} == {"S7": (Decimal("9.50"), Decimal(10**12 - 3)), "S9": (Decimal("5E11"), Decimal("5E11")), "S8": (None, None), "S6": (None, None), None: (4, 4)}
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "concat" not in plan and plan.count("Exchange") == 1


def test_shares_are_the_same_for_groups_ranked_in_a_task_and_dealt_by_value(spark, monkeypatch):
    rows = [(k % 3, float(k * 7 % 40), k) for k in range(200)] + [(1, None, 500), (4, None, 7), (None, 2.0, 9), (None, 1.0, 3)]
    df = spark.createDataFrame(rows, "d int, v double, x long")
    shares = lambda: sorted(map(tuple, ranks.with_shares(df, "d", ["v"], "share", {"top": "v", "most": "x"}).collect()), key=str)
    in_tasks = shares()
    monkeypatch.setattr(ranks, "GROUP_ROWS", 66)  # day 2 stays small
    assert shares() == in_tasks and len(in_tasks) == len(rows)
    plain = pd.DataFrame(rows, columns=["d", "v", "x"])
    g = plain.groupby("d", dropna=False)
    plain["share"], plain["top"], plain["most"] = g.v.rank(pct=True), g.v.transform("max"), g.x.transform("max")
    got = pd.DataFrame(in_tasks, columns=["d", "v", "x", "share", "top", "most"]).astype(float)
    order = lambda t: t[["d", "v", "x", "share", "top", "most"]].astype(float).sort_values(["x", "d", "v"]).to_numpy()
    assert order(got) == pytest.approx(order(plain), nan_ok=True)


@pytest.mark.parametrize("most", [500_000, 1])
def test_metrics_of_days_that_fit_a_task_need_no_join_and_values_beyond_doubles_differ(spark, monkeypatch, most):
    monkeypatch.setattr(ranks, "GROUP_ROWS", most)
    value = Decimal(10**17)
    rows = [(s, None if s == "N" else D0, value + Decimal(cents) / 100, 10, 5, Decimal(10), 1) for s, cents in (("A", 1), ("B", 2), ("C", 2), ("D", 0), ("N", 0))]
    bars_ = spark.createDataFrame(rows, "symbol string, trade_date date, net_trdval decimal(24,2), net_trdqty long, trades long, close decimal(18,2), day int")
    m = liquidity.liquidity_metrics(bars_)
    assert {r["symbol"]: r["turnover_rank_pct"] for r in m.collect()} == {"A": 0.5, "B": 0.875, "C": 0.875, "D": 0.25, "N": 1.0}
    if most > 1:
        plan = m.select("*")._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange") == 1
