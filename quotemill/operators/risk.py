"""Entry, stop and target prices of signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.coerce import blank_to_null
from quotemill.operators.indicators import series
from quotemill.operators.signals import all_signals

STOP_ATR, TARGET_ATR = 1.5, 3.0
#: Per mille of the entry price, without an ATR.
STOP_SHARE, TARGET_SHARE = 5, 10


def _later() -> Column:
    return F.coalesce(blank_to_null(F.col("entry_model")), F.lit("next_open")) == "next_open"


def _entered(df: DataFrame) -> DataFrame:
    """df (entry_open, trade_close) with entry_price and entry_source."""
    source = F.when(F.col("entry_open").isNotNull(), "entry_open").when(F.col("trade_close").isNotNull(), "trade_close_fallback")
    return df.withColumn("entry_price", F.coalesce("entry_open", "trade_close").cast("decimal(18,2)")).withColumn("entry_source", source).drop("entry_open", "trade_close")


def _dated(signals: DataFrame) -> DataFrame:
    return signals.drop("entry_price").withColumn("entry_date", F.when(_later(), F.date_add("trade_date", 1)).otherwise(F.col("trade_date")))


def with_entries(signals: DataFrame, bars: DataFrame) -> DataFrame:
    """Signals with entry_date, entry_price and entry_source: the open of the entry date, else the close of the trade date.

    Signals that enter at the next open enter on the next calendar day.
    """
    opens = bars.select("symbol", F.col("trade_date").alias("entry_date"), F.col("open").alias("entry_open"))
    today = bars.select("symbol", "trade_date", F.col("close").alias("trade_close"))
    return _entered(_dated(signals).join(opens, ["symbol", "entry_date"], "left").join(today, ["symbol", "trade_date"], "left"))


def with_risk(entries: DataFrame, features: DataFrame) -> DataFrame:
    """Stops and targets for momentum and gap signals; prices that are there and not zero stay. Rounded half up to 4 places.

    With an ATR they lie multiples of it away from the entry, a gap's stop from the close before;
    without one, a share of the entry away.
    """
    return _risked(entries.join(features.select("symbol", "trade_date", "atr_14", "prev_close"), ["symbol", "trade_date"], "left"))


def priced(features: DataFrame, keep: tuple[str, ...] = (), **how) -> DataFrame:
    """with_risk(with_entries(all_signals(features))) in one pass: the next day's open is the next row's, so that nothing is joined. Columns named in ``keep`` stay."""
    w = series()
    tomorrow = F.when(F.lead("trade_date").over(w) == F.date_add("trade_date", 1), F.lead("open").over(w))
    df = all_signals(features.withColumn("next_open", tomorrow), keep=("next_open", "open", "close", "atr_14", "prev_close", *keep), **how)
    df = _dated(df).withColumn("entry_open", F.when(_later(), F.col("next_open")).otherwise(F.col("open"))).withColumnRenamed("close", "trade_close")
    return _risked(_entered(df)).drop("next_open", "open")


def _risked(df: DataFrame) -> DataFrame:
    sign = F.when(F.col("signal_type") == "SHORT", -1).otherwise(1)
    entry, atr = F.col("entry_price").cast("double"), F.col("atr_14")
    anchor = F.when(F.col("strategy") == "gap", F.coalesce(F.col("prev_close").cast("double"), entry)).otherwise(entry)
    share = lambda parts: F.round(F.col("entry_price") + F.col("entry_price") * sign * F.lit(parts) / 1000, 4).cast("double")
    stop = F.coalesce(F.round(anchor - sign * atr * STOP_ATR, 4), share(-STOP_SHARE))
    target = F.coalesce(F.round(entry + sign * atr * TARGET_ATR, 4), share(TARGET_SHARE))
    ours = F.col("strategy").isin("momentum", "gap") & F.col("entry_price").isNotNull()
    fill = lambda name, value: F.when(F.col(name).isNotNull() & (F.col(name) != 0), F.col(name)).when(ours, value).otherwise(F.col(name))
    imputed = lambda name: ours & F.coalesce(F.col(name) == 0, F.lit(True))
    return df.withColumns(
        {
            "stop_imputed": imputed("stop_price"),
            "target_imputed": imputed("target_price"),
            "stop_price": fill("stop_price", stop),
            "target_price": fill("target_price", target),
            "method": F.when(ours, F.when(atr.isNotNull(), "atr").otherwise("percent")),
        }
    ).drop("atr_14", "prev_close")


def enrichment_counts(priced: DataFrame) -> DataFrame:
    return priced.groupBy("strategy").agg(
        F.count("*").alias("signals"),
        F.count_if(F.col("method") == "atr").alias("atr_available"),
        F.count_if(F.col("method") == "percent").alias("percent_fallback_used"),
        F.count_if(F.col("entry_source") == "trade_close_fallback").alias("entry_from_close"),
    )
