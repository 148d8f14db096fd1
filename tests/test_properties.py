"""What must hold for any bars, on the smallest tables and on random series against pandas."""

import os

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotemill.operators import indicators
from quotemill.plans.catalogue import QUERIES
from quotemill.streaming import candles as streams

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@needs_tables
def test_indicator_ranges(spark):
    f = QUERIES["feature_long"](spark, SF)
    assert f.where("feature_name = 'atr_14' and value < 0").count() == 0
    assert f.where("feature_name = 'rsi_14' and (value < 0 or value > 100)").count() == 0
    m = QUERIES["liquidity_metrics"](spark, SF)
    assert m.where("turnover_rank_pct <= 0 or turnover_rank_pct > 1 or turnover_norm < 0 or turnover_norm > 1 or vol_norm > 1").count() == 0


@needs_tables
def test_wins_and_losses_have_their_sign(spark):
    rows = QUERIES["labels_intraday"](spark, SF)
    assert rows.where("label = 'win' and ((side = 'LONG' and exit_price < entry_used) <> (realized_return < 0))").count() == 0
    assert rows.where("ambiguous = 1 and (label <> 'neutral' or exit_price is not null)").count() == 0


@needs_tables
def test_class_counts_add_up(spark):
    d = QUERIES["conversion_summary"](spark, SF)
    chop = QUERIES["conversion_classes"](spark, SF).where("classification = 'CHOP'").groupBy("trade_date").agg(F.count("*").alias("chop"))
    bad = d.join(chop, "trade_date", "left").where("good_selection + bad_selection + missed_opportunity + correct_rejection + coalesce(chop, 0) <> candidate_count")
    assert bad.count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(100, 9999), st.integers(0, 500), st.integers(0, 500)), min_size=1, max_size=45))
def test_windows_agree_with_pandas(spark, rows):
    p = pd.DataFrame([(k, c / 100, (c + up) / 100, max(1, c - down) / 100) for k, (c, up, down) in enumerate(rows)], columns=["day", "close", "high", "low"])
    df = spark.createDataFrame(p).select(F.lit("A").alias("symbol"), "day", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("close", "high", "low")])
    w = indicators.series()
    c, h, low = F.col("close"), F.col("high"), F.col("low")
    df = df.withColumn("pc", indicators.previous(c, w)).withColumn("tr", indicators.range_zero_fill(h, low, F.col("pc")))
    got = df.withColumns({"atr": indicators.rolling_mean(F.col("tr"), w, 14), "sma": indicators.rolling_mean(c, w, 5), "mom": indicators.momentum(c, w), "rsi": indicators.rsi_null_on_zero_loss(c, w)}).orderBy("day").toPandas()
    pc = p.close.shift(1)
    tr = pd.concat([(p.high - p.low).abs(), (p.high - pc).abs(), (p.low - pc).abs()], axis=1).fillna(0).max(axis=1)
    change = p.close.diff()
    gain, loss = change.clip(lower=0).rolling(14).mean(), (-change.clip(upper=0)).rolling(14).mean()
    for name, want in (("atr", tr.rolling(14).mean()), ("sma", p.close.rolling(5).mean()), ("mom", p.close.pct_change(20) * 100)):
        assert np.allclose(got[name].astype(float), want, rtol=1e-9, atol=1e-9, equal_nan=True)
    some = loss > 1e-9
    assert np.allclose(got["rsi"].astype(float)[some], (100 - 100 / (1 + gain / loss))[some], rtol=1e-6)
    assert got["rsi"].astype(float)[~some & gain.notna()].isna().all()


def test_streams_catch_up_without_repeating(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    ticks = spark.range(200).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 30).alias("ts"), F.col("id").alias("event_id"), (F.col("id") % 7).cast("double").alias("value"))
    schema = "ts timestamp, event_id long, value double"

    def run():
        streams.catch_up(streams.candle_stream(streams.tick_stream(spark, src, schema)), out, state).awaitTermination()
        return spark.read.schema("ts timestamp, volume long").parquet(out).collect()

    ticks.where("event_id < 100").coalesce(1).write.parquet(src)
    first = run()
    ticks.where("event_id >= 100").coalesce(1).write.mode("append").parquet(src)
    second = run()
    assert len(first) < len(second) and len({r["ts"] for r in second}) == len(second)
    assert len(run()) == len(second)


def test_stream_of_corrected_days_replaces_them(spark, tmp_path):
    src, root, state = (str(tmp_path / x) for x in ("src", "root", "state"))
    schema = "trade_date date, symbol string, close double"
    for close in (1.0, 2.0):
        spark.createDataFrame([("2025-01-01", "A", close)], "d string, symbol string, close double").select(F.to_date("d").alias("trade_date"), "symbol", "close").coalesce(1).write.mode("append").parquet(src)
        streams.upsert_dates(spark.readStream.schema(schema).parquet(src), root, state).awaitTermination()
    assert [r["close"] for r in spark.read.parquet(root).collect()] == [2.0]
