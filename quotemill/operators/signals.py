"""Signal generators over bars with features, all dates at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.coerce import ratio


def main_board(bars: DataFrame) -> DataFrame:
    """Main-board rows of securities, not of indices; all rows where a column is missing."""
    for name, test in (("mkt_flag", F.col("mkt_flag") == 0), ("ind_sec", F.upper("ind_sec") == "N")):
        if name in bars.columns:
            bars = bars.where(test)
    return bars


def _record(strategy: str, side: Column, score: Column, model: str, hold: int, entry=None, stop=None, target=None) -> Column:
    none = F.lit(None).cast("double")
    return F.struct(
        F.lit(strategy).alias("strategy"),
        F.lit("v1").alias("version"),
        side.alias("signal_type"),
        score.alias("signal_score"),
        F.lit(model).alias("entry_model"),
        (none if entry is None else entry.cast("double")).alias("entry_price"),
        (none if stop is None else stop).alias("stop_price"),
        (none if target is None else target).alias("target_price"),
        F.lit(hold).alias("expected_hold_days"),
    )


def gap_percent(open_: Column, before: Column) -> Column:
    return ratio(open_ - before, before) * 100


def _momentum() -> Column:
    return _record("momentum", F.when(F.col("mom_20") >= 0, "LONG").otherwise("SHORT"), F.col("mom_20"), "next_open", 5)


def _gap() -> Column:
    return _record("gap", F.when(F.col("gap_pct") > 0, "LONG").otherwise("SHORT"), F.col("gap_pct"), "open", 1, entry=F.col("open"))


def _breakout(stop: float = 1.5, target: float = 3.0) -> Column:
    close, atr = F.col("close").cast("double"), F.col("atr_14")
    score = F.coalesce(ratio(F.col("close") - F.col("prior_high"), F.col("prior_high")), F.lit(0.0))
    return _record("breakout", F.lit("LONG"), score, "next_open", 10, entry=F.col("close"), stop=F.round(close - atr * stop, 6), target=F.round(close + atr * target, 6))


BROKEN_OUT = "close > prior_high and atr_14 is not null"


def _by_momentum():
    return Window.partitionBy("trade_date").orderBy(F.abs("mom_20").desc_nulls_last(), "symbol")


def _out(rows: DataFrame, records: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    return rows.select("trade_date", "symbol", *keep, F.inline(records))


def momentum_signals(features: DataFrame, top: int = 20) -> DataFrame:
    """Each day's ``top`` largest moves up or down; ties go to the smaller symbol."""
    rows = main_board(features).where("mom_20 is not null").withColumn("nth", F.row_number().over(_by_momentum())).where(F.col("nth") <= top)
    return _out(rows, F.array(_momentum()))


def gap_signals(features: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Opens at least ``threshold`` percent from the close before, bounds included."""
    rows = main_board(features).withColumn("gap_pct", gap_percent(F.col("open"), F.col("prev_close"))).where(F.abs("gap_pct") >= threshold)
    return _out(rows, F.array(_gap()))


def breakout_signals(features: DataFrame) -> DataFrame:
    """Closes strictly above the highest high of the 20 calendar days before, where there is an ATR."""
    return _out(main_board(features).where(BROKEN_OUT), F.array(_breakout()))


def all_signals(features: DataFrame, top: int = 20, gap: float = 2.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """The union of the three, in one pass: the features are computed once, and each row gives the signals it has."""
    rows = main_board(features).withColumns({"gap_pct": gap_percent(F.col("open"), F.col("prev_close")), "nth": F.row_number().over(_by_momentum())})
    found = F.array(F.when(F.col("mom_20").isNotNull() & (F.col("nth") <= top), _momentum()), F.when(F.abs("gap_pct") >= gap, _gap()), F.when(F.expr(BROKEN_OUT), _breakout()))
    some = (F.col("mom_20").isNotNull() & (F.col("nth") <= top)) | (F.abs("gap_pct") >= gap) | F.expr(BROKEN_OUT)
    return _out(rows.where(some), F.filter(found, lambda x: x.isNotNull()), keep)


def repaired_type(score: Column) -> Column:
    """The side that a score stands for; a missing score is SHORT."""
    return F.when(score >= 0, "LONG").otherwise("SHORT")
