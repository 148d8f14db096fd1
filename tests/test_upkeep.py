"""Stores, streams and series that change or are long: against plain versions, and after a crash."""

import datetime as dt
import hashlib
import io
import json
import os
import random
import zipfile
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quotemill.operators import barriers, corrections, hold, indicators, ranks, rules, segments, sessions
from quotemill.sources import archive, manifest, store
from quotemill.streaming import status

D0 = dt.date(2024, 1, 1)
T0 = dt.datetime(2024, 1, 1)


def day(k):
    return D0 + dt.timedelta(days=k)


# status of jobs


def plain_status(events, passed_us):
    """The ordered fold, job by job; events: (job, at in microseconds, event, proposed)."""
    out = []
    for job in sorted({e[0] for e in events}):
        state, since = "", 0

        def end(before):
            nonlocal state, since
            if state in status.OPEN and since + status.EXPIRY < before:
                since += status.EXPIRY
                out.append((job, None, since, state, "failed", "failed", True))
                state = "failed"

        for _, at, event, proposed in sorted(e for e in events if e[0] == job and e[1] <= passed_us):
            end(at)
            legal = proposed in status.MOVES[state]
            out.append((job, event, at, state, proposed, proposed if legal else state, legal))
            if legal:
                state, since = proposed, at
        end(passed_us // 1000 * 1000 + 1)
    return Counter(out)


def test_status_goes_on_from_its_checkpoint(spark, tmp_path):
    r = random.Random(2)
    micros = lambda minutes: int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) + minutes * 60_000_000
    states = ["pending", "downloaded", "committed", "success", "failed", "holiday"]
    events = [(f"j{r.randrange(4)}", micros(r.randrange(0, 3000)), k, r.choice(states)) for k in range(150)]
    events = list({(e[0], e[1]): e for e in events}.values())
    early, late = [e for e in events if e[1] < micros(1500)], [e for e in events if e[1] >= micros(1500)]
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "job string, ts timestamp, event_id long, proposed string"

    def add(rows):
        r.shuffle(rows)
        spark.createDataFrame([(j, at, k, p) for j, at, k, p in rows], "job string, at long, event_id long, proposed string").select("job", F.timestamp_micros("at").alias("ts"), "event_id", "proposed").coalesce(1).write.mode("append").parquet(source)

    def run():
        with status.state_store(spark):
            rows = status.status_stream(spark.readStream.schema(schema).parquet(source), ["job"])
            rows.writeStream.foreachBatch(lambda df, n: store.write_batch(df, n, out) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return Counter(tuple(x) for x in store.read_batches(spark, out).select("job", "event_id", "at_us", "from_state", "proposed", "to_state", "accepted").collect())

    mark = lambda rows: (max(e[1] for e in rows) // 1000 - 600_000) * 1000 + 999
    add(early)
    assert run() == plain_status(early, mark(early))
    add(late)
    found = run()
    assert found == plain_status(events, mark(events))
    assert any(not x[6] for x in found) and any(x[1] is None for x in found)


class Told:
    """A slot's states in memory, with a count of calls."""

    def __init__(self):
        self.calls, self.values, self.timers = Counter(), {}, set()

    def getListState(self, name, schema):
        return Told.State(self, name, [])

    def getValueState(self, name, schema):
        return Told.State(self, name, None)

    def getMapState(self, name, *schemas):
        return Told.State(self, name, {})

    def listTimers(self):
        self.calls["timers"] += 1
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.calls["timers"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls["timers"] += 1
        self.timers.discard(at)

    def getCurrentWatermarkInMs(self):
        return self.mark

    class State:
        def __init__(self, of, name, value):
            self.of, self.name, self.value = of, name, value

        def _call(self, value):
            self.of.calls[self.name] += 1
            return value

        def exists(self):
            return self._call(self.value is not None)

        def get(self):
            return self._call(self.value)

        def update(self, value):
            self.value = self._call(value)

        put = update

        def clear(self):
            self.value = self._call([])

        def appendValue(self, value):
            self._call(self.value.append(value))

        def getValue(self, key):
            return self._call(self.value.get(key))

        def updateValue(self, key, value):
            self.value[key] = self._call(value)


def test_calls_of_state_go_by_slot_and_page_and_not_by_job():
    r, told, found = random.Random(4), Told(), []
    events = [(f"j{r.randrange(500)}", 1_000 * r.randrange(30 * 3_600_000), k, r.choice(list(status.MOVES)[1:])) for k in range(3000)]
    machine = status.JobStatus()
    machine.init(told)
    for part in range(3):  # batches that don't follow time
        rows = pd.DataFrame(events[part::3], columns=["job", "at", "event_id", "proposed"])
        machine.handleInputRows((0,), iter([rows[:500], rows[500:]]), None)
    for told.mark in (5 * 3_600_000, 20 * 3_600_000, 40 * 3_600_000):
        assert min(told.timers) <= told.mark
        found += [tuple(None if pd.isna(v) else v for v in x) for df in machine.handleExpiredTimer((0,), told, None) for x in df.itertuples(index=False)]
    assert Counter(found) == plain_status(events, 40 * 3_600_000_000 + 999)
    assert not told.timers and sum(told.calls.values()) < 200


def test_a_batch_that_died_before_its_ledger_entry_is_written_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    batch = lambda k: spark.createDataFrame([(k, i) for i in range(3)], "k int, i int")
    assert store.write_batch(batch(0), 0, root)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "put", dies)
        with pytest.raises(RuntimeError):
            store.write_batch(batch(1), 1, root)
    assert {r["k"] for r in store.read_batches(spark, root).collect()} == {0}  # rows are there, and don't count
    assert store.write_batch(batch(1), 1, root)
    assert not store.write_batch(batch(9), 1, root)
    assert Counter((r["batch"], r["k"]) for r in store.read_batches(spark, root).collect()) == Counter({(0, 0): 3, (1, 1): 3})


def test_a_small_file_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "status.json")
    for state in ("pending", "success"):
        store.put(spark, path, json.dumps({"state": state}))
        assert json.loads(store.got(spark, path)) == {"state": state}
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["status.json"]


# corrections


def random_bars(r, symbols, days, nulls=0.0):
    rows = []
    for s in range(symbols):
        for k in range(days):
            if r.random() < (0.85 if s else 0.2):  # the first symbol has few bars
                o, h = 50 + r.randrange(100), 160 + r.randrange(50)
                rows.append((f"S{s}", day(k), o, h, 10 + r.randrange(30), None if r.random() < nulls else 60 + r.randrange(90)))
    return rows


def bar_frame(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, trade_date date, open int, high int, low int, close int")
    return df.select("symbol", "trade_date", F.unix_date("trade_date").alias("day"), *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("open", "high", "low", "close")])


def test_corrected_features_are_those_of_all_bars(spark):
    r = random.Random(5)
    rows = random_bars(r, 4, 300, 0.03)
    old = [x for x in rows if not (x[1] >= day(270) and r.random() < 0.1)]
    old = [(*x[:5], None if x[5] is None else x[5] + 7) if x[1] >= day(275) and r.random() < 0.2 else x for x in old]
    now = [x for x in rows if not (x[1] >= day(280) and r.random() < 0.1)]
    before, after = bar_frame(spark, old), bar_frame(spark, now)
    changed = corrections.changed_keys(before, after, ("open", "high", "low", "close"))
    features = indicators.with_features(before).select("symbol", "trade_date", *corrections.FEATURES)
    want = indicators.with_features(after).select("symbol", "trade_date", *corrections.FEATURES)
    as_rows = lambda df: Counter(tuple(x) for x in df.collect())
    assert as_rows(corrections.corrected_features(features, after, changed)) == as_rows(want)
    near = corrections.needed(after, changed)
    assert near.where("symbol <> 'S0'").count() < 0.45 * after.where("symbol <> 'S0'").count()  # S0 has too few bars in the halo and is read whole
    assert corrections.reached(near, changed).count() < near.count()
    assert as_rows(corrections.corrected_features(features, before, changed.limit(0))) == as_rows(features)


def test_a_store_by_month_is_pruned(spark, tmp_path):
    rows = bar_frame(spark, random_bars(random.Random(1), 3, 400)).withColumn("month", F.trunc("trade_date", "month"))
    rows.write.partitionBy("month").parquet(str(tmp_path / "bars"))
    kept = spark.read.parquet(str(tmp_path / "bars"))
    changed = spark.createDataFrame([("S1", day(390))], "symbol string, trade_date date")
    plan = corrections.needed(kept, changed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


# merges


def bytes_of(folder):
    return {os.path.join(d, f): hashlib.md5(open(os.path.join(d, f), "rb").read()).hexdigest() for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_merge_leaves_other_files_as_they_are(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    rows = [(f"2024-{m:02}", k, f"s{k % 7}", m * 1000 + k) for m in range(1, 7) for k in range(500)]
    schema = "month string, k int, s string, v int"
    manifest.create(spark.createDataFrame(rows, schema), root, "month", ["k", "s"], 200)
    files, want = bytes_of(root + "/data"), {x[:3]: x[3] for x in rows}
    new = [("2024-03", 10, "s3", -1), ("2024-03", 10, "s3", -2), ("2024-03", 9999, "x", 5), ("2025-01", 1, "y", 6)]

    def check():
        assert Counter(tuple(x) for x in manifest.read(spark, root).collect()) == Counter((*k, v) for k, v in want.items())

    with monkeypatch.context() as m:  # a merge that dies before the pointer moves changes nothing
        m.setattr(store, "put", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            manifest.merge(spark.createDataFrame(new, schema), root, "month", ["k", "s"], ("v",), 200)
    check()
    counts = manifest.merge(spark.createDataFrame(new, schema), root, "month", ["k", "s"], ("v",), 200)
    want |= {("2024-03", 10, "s3"): -1, ("2024-03", 9999, "x"): 5, ("2025-01", 1, "y"): 6}
    check()
    assert counts["read"] == 1 and counts["kept"] >= 13
    assert {f: h for f, h in bytes_of(root + "/data").items() if f in files} == files
    # keys between two keys of a file, in none: the filters tell
    assert manifest.merge(spark.createDataFrame([("2024-02", 100, "none", 1)], schema), root, "month", ["k", "s"], (), 200)["read"] == 0
    want[("2024-02", 100, "none")] = 1
    check()


def test_a_large_table_is_written_by_few_tasks_and_asked_by_cells(spark, tmp_path):
    """Files of so many rows, several of them by one task; keys meet files by number, and find all and only those that hold them."""
    root, n = str(tmp_path / "t"), 6000
    rows = [("p" if k % 3 else "q", k * 7 % 5000 // 2, f"s{k}", k) for k in range(n)]
    manifest.create(spark.createDataFrame(rows, "month string, k int, s string, v int"), root, "month", ["k", "s"], 100)
    at = manifest.manifest(spark, root)
    names = [r["file"] for r in at.select("file").distinct().collect()]
    assert len({os.path.basename(f).split("-")[1] for f in names}) == 1 and len(names) == n // 100
    held = spark.read.parquet(*names).withColumn("file", F.col("_metadata.file_path")).collect()
    spans = {}
    for r in held:
        spans.setdefault((r["file"], r["month"]), []).append((r["k"], r["s"]))
    assert {(r["file"], r["part"]): (tuple(r["least"]), tuple(r["most"]), r["n"]) for r in at.collect()} == {x: (min(v), max(v), len(v)) for x, v in spans.items()}
    for part in (held[:1], held[5:900:150], held):
        new = spark.createDataFrame([(r["month"], r["k"], r["s"]) for r in part], "month string, k int, s string")
        got = {r["file"] for r in manifest.touched(new, at, "month", ["k", "s"]).collect()}
        assert got >= {r["file"] for r in part} and len(got) <= len({r["file"] for r in part}) + 3
    plan = manifest.touched(new, at, "month", ["k", "s"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, ((part" in plan and "cell" in plan


def test_merges_into_an_empty_table(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "month string, k int, v int"
    manifest.create(spark.createDataFrame([], schema), root, "month", ["k"])
    assert manifest.read(spark, root).collect() == [] and manifest.read(spark, root).columns == ["month", "k", "v"]
    manifest.merge(spark.createDataFrame([("a", 1, 2)], schema), root, "month", ["k"])
    manifest.merge(spark.createDataFrame([], schema), root, "month", ["k"])
    assert [tuple(x) for x in manifest.read(spark, root).collect()] == [("a", 1, 2)]


# series in chunks


def candle_frame(spark, r, n, by=()):
    at, rows = 0, []
    for k in range(n):
        at += r.choice((5, 5, 5, 10, 60, 3000, 30000))
        rows.append((f"X{k % 2}", T0 + dt.timedelta(minutes=at), 100 + r.randrange(50), 200 + r.randrange(9), 20 + r.randrange(9), None if r.random() < 0.02 else 90 + r.randrange(60), r.randrange(5)))
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, open int, high int, low int, close int, volume int")
    return df.select("symbol", "ts", "volume", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("open", "high", "low", "close")])


@pytest.mark.parametrize("by", [(), ("symbol",)])
def test_indicators_over_chunks_are_those_of_one_window(spark, by):
    rows = candle_frame(spark, random.Random(4), 400)
    whole = rows.withColumn("all", F.lit(0))
    one = indicators.over_chunks(whole, [*by], 0, lambda d, keys: d, "ts", "100000 days")  # one chunk: no halo
    assert one.count() == 400
    wide, cut = (indicators.candle_indicators(rows, by, width=w).select("symbol", "ts", "sma_5", "sma_20", "rsi", "atr") for w in ("100000 days", "1 day"))
    assert Counter(tuple(x) for x in cut.collect()) == Counter(tuple(x) for x in wide.collect())
    assert cut.count() > 200


def test_running_sums_over_chunks(spark):
    rows = candle_frame(spark, random.Random(6), 300)
    found = segments.running(rows, ["symbol"], {"total": F.col("close"), "n": F.lit(1)}, width="1 day").toPandas().sort_values(["symbol", "ts"])
    for _, part in found.groupby("symbol"):
        closes = [None if x is None else float(x) for x in part["close"]]
        run, want = None, []
        for c in closes:
            run = run if c is None else (run or 0) + c
            want.append(run)
        assert [None if x is None else float(x) for x in part["total"]] == want and part["n"].tolist() == list(range(1, len(part) + 1))


def test_first_hits_by_descent():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 64, 300):
        high, low = r.integers(50, 100, n), r.integers(0, 50, n)
        at, up, down = r.integers(0, n + 1, 500), r.integers(60, 110, 500), r.integers(-10, 40, 500)
        want = [next((j for j in range(a, n) if high[j] >= u or low[j] <= d), n) for a, u, d in zip(at, up, down, strict=True)]
        assert barriers.first_hits(high, low, at, up, down).tolist() == want


@pytest.mark.parametrize("width, block", [(None, 64), ("20 days", 64), ("7 days", 2)])
def test_days_to_a_barrier(spark, monkeypatch, width, block):
    monkeypatch.setattr(barriers, "BLOCK", block)
    rows = random_bars(random.Random(9), 3, 120, 0.05)
    for ahead in (None, 10):
        found = hold.with_barrier(bar_frame(spark, rows), 1.2, 0.8, ahead, width)
        got = {(x["symbol"], x["trade_date"]): x["days"] for x in found.collect()}
        want = {}
        for s in {x[0] for x in rows}:
            series = sorted(x for x in rows if x[0] == s)
            for i, x in enumerate(series):
                up, down = (None, None) if not x[5] else (x[5] * 2.2, x[5] * 0.2)
                steps = next((j - i for j in range(i + 1, len(series)) if up and (series[j][3] >= up - 1e-9 or series[j][4] <= down + 1e-9)), None)
                want[(s, x[1])] = steps if steps and (ahead is None or steps <= ahead) else None
        assert got == want and any(v for v in want.values())


# ranks


def test_ranks_of_a_large_group_are_dealt_over_ranges(spark):
    r = random.Random(3)
    rows = [(0, r.randrange(3000)) for _ in range(20_000)] + [(1, 5)] * 300 + [(2, None), (3, 7), (3, None)]
    df = spark.createDataFrame(rows, "d int, v int")
    found = ranks.ranked(df, "d", "v")
    table = found.withColumn("share", ranks.rank_share()).toPandas()
    plain = pd.DataFrame(rows, columns=["d", "v"]).dropna()
    plain["share"] = plain.groupby("d")["v"].rank() / plain.groupby("d")["v"].transform("count")
    want = {(int(d), int(v)): s for d, v, s in plain.itertuples(index=False)}
    assert {(d, v): s for d, v, s in table[["d", "v", "share"]].itertuples(index=False)} == pytest.approx(want)
    for share in (0, 0.3, 0.7, 1):
        got = {x["d"]: float(x["quantile"]) for x in ranks.quantiles(found, "d", "v", share).collect()}
        assert got == pytest.approx(plain.groupby("d")["v"].quantile(share).to_dict())
    assert found.select("d").where("d = 2").count() == 0


# archives, patches, rules, stores


def zipped(members):
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return made.getvalue()


def files_frame(spark, contents):
    return spark.createDataFrame([(f"/{k}.zip", T0, bytearray(c)) for k, c in enumerate(contents)], "path string, modificationTime timestamp, content binary")


def test_short_rows_stay_and_long_ones_decide_the_form(spark):
    text = "a,b,c\n1\n\n1,2,3,4\n5,6,7\n"
    lenient = archive.member_rows(files_frame(spark, [zipped({"PR031025.csv": text})])).collect()
    assert [r["fields"] for r in lenient] == [{"A": "1"}, {"A": "5", "B": "6", "C": "7"}]
    semicolons = "a;b\n1,5;2\n3;4,5,6\n"  # by commas some rows are too long
    sniffed = archive.member_rows(files_frame(spark, [zipped({"x.csv": semicolons})]), sniff=True).collect()
    assert [r["fields"] for r in sniffed] == [{"A": "1,5", "B": "2"}, {"A": "3", "B": "4,5,6"}]
    assert archive.projected(archive.member_rows(files_frame(spark, [zipped({"PR031025.csv": text})])), "PR", {"c": ("C",)}).select("c").collect()[0]["c"] is None


def test_damaged_archives_are_told(spark):
    whole = zipped({"PR031025.csv": "a,b\n1,2\n"})
    at = whole.index(b"1,2")
    rows = archive.member_rows(files_frame(spark, [whole, whole[:30], whole[:at] + b"9" + whole[at + 1 :], b"PK", b"", b"text"])).collect()
    told = {r["archive"]: (r["member"], r["fields"], r["fault"] is not None) for r in rows}
    assert told == {"/0.zip": ("PR031025.csv", {"A": "1", "B": "2"}, False), "/1.zip": (None, None, True), "/2.zip": ("PR031025.csv", None, True), "/3.zip": (None, None, True)}


def test_members_are_read_as_the_library_for_archives_does(spark):
    """Every way of packing, folders, names that come twice, long members, bytes before the archive; encrypted ones are told."""
    made, long = io.BytesIO(), "a,b\n" + "".join(f"{k},{k * k}\n" for k in range(archive.CHUNK + 5))
    with zipfile.ZipFile(made, "w") as z:
        for how in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA):
            z.writestr(f"in/GL0{how}1025.csv", long, how)
        z.writestr("pr.csv", "a\nold\n")
        z.writestr("pr.CSV", "")
        z.writestr("readme.txt", "a,b\n1,2\n")
        with pytest.warns(UserWarning):
            z.writestr("pr.csv", "a\nnew\n", zipfile.ZIP_DEFLATED)
    content = made.getvalue()
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        want = Counter((n, k, tuple(sorted(row.items()))) for n in set(z.namelist()) if n.upper().endswith(".CSV") for k, row in enumerate(archive._rows(z.read(n), False)))
    locked = bytearray(zipped({"x.csv": "a\n1\n"}))
    locked[locked.index(b"PK\x01\x02") + 8] |= 1
    files = files_frame(spark, [content, b"PK before" + content, bytes(locked), zipped({})])
    rows = archive.member_rows(files).collect()
    assert {(r["archive"], r["member"], r["fault"]) for r in rows if r["fault"]} == {("/2.zip", "x.csv", "encrypted")}
    for name in ("/0.zip", "/1.zip"):
        assert Counter((r["member"], r["row_seq"], tuple(sorted(r["fields"].items()))) for r in rows if r["archive"] == name) == want
    assert len(want) == 4 * (archive.CHUNK + 5) + 1


def test_members_come_by_columns_and_not_by_row(spark, monkeypatch):
    """Headers that come twice, short rows, quoted and empty fields, no rows and no header: as row by row, without a Python object a row."""
    texts = ["a,b,a\n1\n1,2\n1,2,3\n", 'a,b\n"x,\ny",\n,\n5\n', "a,b\n", "", "a\n1,2\n"]
    for text in texts:
        assert [dict(x) for x in archive._maps(*archive._lines(text.encode(), False)).to_pylist()] == archive._rows(text.encode(), False)
    rows = archive.parsed(archive.entries(files_frame(spark, [zipped({f"GL0{k}1025.csv": t for k, t in enumerate(texts, 1)})])))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract" not in plan[: plan.index("MapInArrow")]  # kind and day are told once a member
    got = Counter((r["member"], r["row_seq"], tuple(sorted(r["fields"].items()))) for r in rows.collect())
    assert got == Counter((f"GL0{k}1025.csv", n, tuple(sorted(row.items()))) for k, t in enumerate(texts, 1) for n, row in enumerate(archive._rows(t.encode(), False)))


def test_members_of_other_kinds_are_not_unpacked(spark):
    whole = zipped({"GL031025.csv": "a\n1\n", "HL031025.csv": "a\n2\n"})
    at = whole.index(b"a\n2")
    files = files_frame(spark, [whole, whole[:at] + b"9" + whole[at + 1 :], whole[:30]])
    got = lambda **how: Counter((r["archive"], r["kind"], r["fault"] is not None) for r in archive.member_rows(files, **how).collect())
    assert got(kinds=("GL",)) == Counter({("/0.zip", "GL", False): 1, ("/1.zip", "GL", False): 1, ("/2.zip", "OTHER", True): 1})
    assert got()["/1.zip", "HL", True] == 1
    chosen = archive.entries(files).where("kind = 'HL' and trade_date = date'2025-10-03'")
    assert chosen.count() == 2 and Counter(r["archive"] for r in archive.parsed(chosen).where("fault is null").collect()) == Counter({"/0.zip": 1})


def test_only_candles_with_a_gap_are_patched(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    bulk = spark.createDataFrame([(at(0), 1, 1), (at(300), None, 2), (at(600), None, None), (at(900), 3, None), (at(1200), None, 4)], "ts timestamp, high int, low int")
    patch = spark.createDataFrame([(at(0), 90, 90), (at(340), 10, None), (at(270), 11, 12), (at(541), 20, 21), (at(960), 30, 31), (at(1261), 40, 41)], "ts timestamp, high int, low int")
    got = lambda **how: {int((x["ts"] - T0).total_seconds()): (x["high"], x["low"]) for x in sessions.patched(bulk, patch, **how).collect()}
    assert got() == {0: (1, 1), 300: (None, 2), 600: (None, None), 900: (3, None), 1200: (None, 4)}
    assert got(within=60) == {0: (1, 1), 300: (11, 12), 600: (20, 21), 900: (30, 31), 1200: (None, 4)}
    assert sessions.patched(bulk, patch.limit(0), within=60).count() == 5


def test_rules_from_a_file(spark, tmp_path):
    config = {"metric_thresholds": {"a": [{"label": "LOW", "type": "lt", "value": 0.4}, {"label": "FINE", "type": "gte", "value": 0.4}], "b": [{"label": "ODD", "type": "between", "value": 1}]}, "label_mappings": {"LOW": "POOR"}, "templates": {"POOR": "Poor.", "FINE": "Fine."}}
    (tmp_path / "rules.json").write_text(json.dumps(config, indent=1))
    frame = rules.rules_from(spark, str(tmp_path / "rules.json"))
    rows = spark.createDataFrame([(1, 0.3, 1.0), (2, 0.4, None), (3, None, None)], "k int, a double, b double")
    found = rules.applied(rules.unpivoted(rows, ["k"], ["a", "b"]), frame, ["k"])
    assert {(r["k"], r["metric"]): r["label"] for r in found.collect()} == {(1, "a"): "POOR", (2, "a"): "FINE", (3, "a"): None, (1, "b"): None, (2, "b"): None, (3, "b"): None}
    assert {r["k"]: (r["a_label"], r["summary_text"]) for r in rules.told(found, ["k"], ["a", "b"]).collect()} == {1: ("POOR", "Poor."), 2: ("FINE", "Fine."), 3: (None, "")}


def test_the_first_row_of_a_key_and_updates_by_a_second_key(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", "x", 0), (2, "b", "y", 0)], "id int, raw string, src string, v int")
    new = spark.createDataFrame([(3, "c", "z", 5), (3, "c", "z", 4), (1, "q", "q", 9)], "id int, raw string, src string, v int")
    assert [tuple(x) for x in store.absent(old, new, ["id"], ("v",)).collect()] == [(3, "c", "z", 4)]
    late = spark.createDataFrame([(1, None, None, 7), (None, "b", "y", 8), (None, "none", "y", 9)], "id int, raw string, src string, v int")
    assert {x["id"]: x["v"] for x in store.updated(old, late, ["id"], ("v",), fallback=["raw", "src"]).collect()} == {1: 7, 2: 8}
    days = spark.createDataFrame([(D0, k) for k in range(200)], "trade_date date, k int")
    for _ in range(2):
        store.write_dates(days, str(tmp_path / "d"), files=3)
        assert spark.read.parquet(str(tmp_path / "d")).count() == 200


def test_barriers_in_later_chunks_of_many_series(spark):
    """Rows that ask and the chunk that they ask for meet in one task, however many there are."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(f"S{s}", D0 + dt.timedelta(days=40 * k), s, 10.0 * (k + 1)) for s in range(20) for k in range(5)]
        bars = spark.createDataFrame(rows, "symbol string, trade_date date, day int, close double").withColumns({c: F.col("close").cast("decimal(18,2)") for c in ("high", "low", "close")})
        found = {(x["symbol"], x["trade_date"]): x["days"] for x in hold.with_barrier(bars, 1.5, 0.9, None, "30 days").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == {(s, at): {0: 2, 1: 3}.get(k) for s, at, k in ((x[0], x[1], round(x[3] / 10) - 1) for x in rows)}


def test_corrections_make_their_bars_once(spark):
    from quotemill.plans import upkeep

    for df in upkeep._corrected(spark, "/root/testdata/sf0.001"):
        assert "lineitem" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["signal_prices_joined", "hold_days_cascade", "signal_entry_prices"])
def test_joins_read_features_that_were_made_once(spark, name):
    from quotemill.plans import catalogue

    assert "lineitem" not in catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
