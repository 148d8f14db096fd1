"""Analytics of intraday sessions from candles (session, ts, open, high, low, close, volume).

Candles of several instruments have a column symbol as well; sessions are then an instrument's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.coerce import exact, ratio

#: India's clock is so far ahead of UTC, the whole year.
INDIA_SECONDS = 19800


def _keys(candles: DataFrame) -> list[str]:
    return [c for c in ("symbol", "session") if c in candles.columns]


def _session(candles: DataFrame):
    return Window.partitionBy(*_keys(candles)).orderBy("ts")


def with_vwap(candles: DataFrame) -> DataFrame:
    """Candles with vwap_equal (mean typical price so far) and vwap_volume (weighted by volume; null before any)."""
    w = _session(candles).rowsBetween(Window.unboundedPreceding, 0)
    three = exact(F.col("high") + F.col("low") + F.col("close"))
    return candles.withColumns(
        {
            "vwap_equal": F.sum(three).over(w).cast("double") / (F.count("*").over(w) * 3),
            "vwap_volume": ratio(F.sum(three * F.col("volume")).over(w), F.sum("volume").over(w) * 3),
        }
    )


def with_crosses(candles: DataFrame, vwap: str = "vwap_equal") -> DataFrame:
    """Candles with crossed: close and VWAP changed sides since the candle before; touching isn't crossing."""
    gap = F.col("close").cast("double") - F.col(vwap)
    return candles.withColumn("gap", gap).withColumn("crossed", F.coalesce(F.lag("gap").over(_session(candles)) * F.col("gap") < 0, F.lit(False)))


def session_summary(candles: DataFrame) -> DataFrame:
    """One row a session: range, net move, trend strength, pullback, VWAP crosses and hold; 0 where the range is 0."""
    rows = with_crosses(with_vwap(candles))
    ends = rows.groupBy(*_keys(candles)).agg(
        F.min_by("open", "ts").alias("day_open"),
        F.max_by("close", "ts").alias("day_close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.count("*").alias("candles"),
        F.count_if("crossed").alias("vwap_cross_count"),
        F.count_if(F.col("gap") > 0).alias("above"),
        F.count_if(F.col("gap") < 0).alias("below"),
    )
    span, move = F.col("high") - F.col("low"), F.col("day_close") - F.col("day_open")
    share = lambda c: F.when(span == 0, F.lit(0.0)).otherwise(ratio(c, span))
    return ends.select(
        *_keys(candles),
        "candles",
        span.cast("double").alias("total_range"),
        move.cast("double").alias("net_move"),
        share(F.abs(move)).alias("trend_strength"),
        share(F.when(move >= 0, F.col("high") - F.col("day_close")).otherwise(F.col("day_close") - F.col("low"))).alias("pullback_depth"),
        F.col("vwap_cross_count").cast("bigint").alias("vwap_cross_count"),
        (F.when(move >= 0, F.col("above")).otherwise(F.col("below")).cast("double") / F.col("candles")).alias("vwap_hold_percentage"),
    )


def structure(candles: DataFrame) -> DataFrame:
    """session, structure (LONG_VALID: all highs and lows rise, SHORT_VALID: all fall, else INVALID), gap_hold and price_vs_vwap.

    gap_hold compares the first open with the close of the session before: YES if the session never
    traded back through it, NO if it did, NO_GAP if equal, null for the first session. A session of
    one candle rises and falls at once, and counts as rising.
    """
    w = _session(candles)
    step = {f"{d}_{c}": F.coalesce((F.col(c) > F.lag(c).over(w)) if d == "up" else (F.col(c) < F.lag(c).over(w)), F.lag(c).over(w).isNull()) for d in ("up", "down") for c in ("high", "low")}
    rows = with_vwap(candles).withColumns(step)
    days = rows.groupBy(*_keys(candles)).agg(
        *[F.bool_and(c).alias(c) for c in step],
        F.min_by("open", "ts").alias("day_open"),
        F.max_by("close", "ts").alias("day_close"),
        F.max_by("vwap_volume", "ts").alias("last_vwap"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
    )
    chain = Window.partitionBy("symbol") if "symbol" in candles.columns else Window.partitionBy(F.lit(0))  # a row a session of an instrument
    days = days.withColumn("before", F.lag("day_close").over(chain.orderBy("session")))
    form = F.when(F.col("up_high") & F.col("up_low"), "LONG_VALID").when(F.col("down_high") & F.col("down_low"), "SHORT_VALID").otherwise("INVALID")
    yes_no = lambda c: F.when(c, "YES").otherwise("NO")
    hold = F.when(F.col("day_open") > F.col("before"), yes_no(F.col("low") >= F.col("before"))).when(F.col("day_open") < F.col("before"), yes_no(F.col("high") <= F.col("before"))).when(F.col("before").isNotNull(), "NO_GAP")
    last = F.col("day_close").cast("double")
    side = F.when(last > F.col("last_vwap"), "ABOVE_VWAP").when(last < F.col("last_vwap"), "BELOW_VWAP").otherwise("AT_VWAP")
    return days.select(*_keys(candles), form.alias("structure"), hold.alias("gap_hold"), (ratio(F.col("day_open") - F.col("before"), F.col("before")) * 100).alias("gap_pct"), side.alias("price_vs_vwap"))


def stock_outcome(bars: DataFrame, side: str = "LONG", up: float = 1.5, down: float = -1.0) -> DataFrame:
    """symbol, trade_date, up_pct, down_pct, range_pct, outcome; the favourable move is tested first, a zero open gives null."""
    o = F.col("open")
    pct = lambda c: ratio(c, o) * 100
    df = bars.select("symbol", "trade_date", pct(F.col("high") - o).alias("up_pct"), pct(F.col("low") - o).alias("down_pct"), pct(F.col("high") - F.col("low")).alias("range_pct"))
    good, bad = (F.col("up_pct") >= up, F.col("down_pct") <= down) if side == "LONG" else (F.col("down_pct") <= -up, F.col("up_pct") >= -down)
    return df.withColumn("outcome", F.when(F.col("up_pct").isNull(), F.lit(None)).when(good, "SUCCESS").when(bad, "FAILURE").otherwise("CHOP"))


def normal_candles(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text candles (timestamp or date or datetime, open, high, low, close, volume) as typed ones with valid and reason.

    Epochs are seconds, or milliseconds beyond 1e12; times without a zone are UTC, whatever the
    session's zone; times come out as India's wall clock, whole seconds. A row that can't be read is kept with valid = false. Columns
    named in ``keep`` stay.
    """
    names = [c for c in ("timestamp", "date", "datetime") if c in raw.columns]
    text = F.trim(F.coalesce(*[F.col(c).cast("string") for c in names]))
    epoch = F.when(text.rlike(r"^\d+(\.\d+)?$"), text.try_cast("double"))
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"\d{2}:\d{2}"), text).when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit(" 00:00:00Z"))).otherwise(F.concat(text, F.lit("Z")))
    seconds = F.coalesce(F.floor(F.when(epoch > 1e12, epoch / 1000).otherwise(epoch)), F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.unix_seconds(zoned.try_cast("timestamp"))))
    india = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds + INDIA_SECONDS)
    numbers = {c: F.col(c).cast("string").try_cast("double") for c in ("open", "high", "low", "close", "volume")}
    df = raw.select(*keep, india.alias("ts"), *[v.alias(c) for c, v in numbers.items()])
    odd = lambda c: F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    reason = F.when(F.col("ts").isNull(), "timestamp")
    for c in numbers:
        reason = reason.when(odd(c), c)
    return df.withColumn("reason", reason.when(F.col("low") > F.col("high"), "low exceeds high")).withColumn("valid", F.col("reason").isNull())


def patched(bulk: DataFrame, patch: DataFrame, key: str = "ts", within: int = 0) -> DataFrame:
    """bulk with the patch's values in candles that have a null, wherever the patch has a value there; candles without a null stay as they are.

    A candle's patch is the one nearest in time, at most ``within`` seconds off; of two as near the earlier
    one. Both sides go into bins of time, so that a candle meets only its neighbours.
    """
    values = [c for c in bulk.columns if c != key]
    gap = F.lit(False)
    for c in values:
        gap = gap | F.col(c).isNull()
    shared = [c for c in values if c in patch.columns]
    other = patch.where(F.col(key).isNotNull()).select(F.col(key).alias("patch_at"), F.struct(*[F.col(c).alias(c) for c in shared]).alias("patch"))
    if within:
        at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
        width = within * 1_000_000
        bin_ = lambda c: F.floor(at(c) / width).cast("long")
        other = other.withColumn("bin", F.explode(F.array(*[bin_("patch_at") + k for k in (-1, 0, 1)])))
        off = F.abs(at("patch_at") - at(key))
        near = bulk.where(gap).select(key).distinct().withColumn("bin", bin_(key)).join(other, "bin").where(off <= width)
        other = near.groupBy(key).agg(F.min_by("patch", F.struct(off.alias("off"), "patch_at")).alias("patch"))
    else:
        other = other.groupBy(F.col("patch_at").alias(key)).agg(F.first("patch").alias("patch"))
    cols: list[Column] = [F.when(gap, F.coalesce(F.col(f"patch.{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in shared else F.col(c) for c in bulk.columns]
    return bulk.join(other, key, "left").select(*cols)
