"""Scans and lookups that every stage starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotemill.functions.coerce import number_text, scalar_json
from quotemill.functions.names import symbol_key
from quotemill.operators.indicators import previous, series
from quotemill.operators.signals import main_board

#: Names that tables may have for a column, the first that is there counts; those of ESSENTIAL must be there.
SYNONYMS = {
    "symbol": ("symbol", "tradingsymbol", "ticker"),
    "trade_date": ("trade_date", "date", "dt"),
    "open": ("open", "open_price", "o"),
    "high": ("high", "high_price", "h"),
    "low": ("low", "low_price", "l"),
    "close": ("close", "close_price", "close_pric", "c"),
    "prev_close": ("prev_close", "prev_cl_pr"),
    "net_trdval": ("net_trdval", "net_trd_val", "turnover"),
    "net_trdqty": ("net_trdqty", "net_trd_qty", "volume"),
    "trades": ("trades", "no_of_trades"),
}
ESSENTIAL = ("symbol", "trade_date", "open", "high", "low", "close")
#: Names of the five-minute interval, the only one that candles are asked for at.
INTERVALS = ("5minute", "5m", "5", "5min")


def resolved_columns(df: DataFrame, synonyms: dict[str, tuple[str, ...]] = SYNONYMS, essential: tuple[str, ...] = ESSENTIAL) -> DataFrame:
    """df under canonical names, whatever the case of its own; other columns go. A missing essential one is an error."""
    have = {c.lower(): c for c in df.columns}
    found = {name: next((have[s] for s in names if s in have), None) for name, names in synonyms.items()}
    if missing := [n for n in essential if not found.get(n)]:
        raise ValueError(f"no column for {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in found.items() if c])


def five_minutes(interval: Column) -> Column:
    """Whether a text names the five-minute interval."""
    return F.coalesce(F.lower(F.trim(interval)).isin(*INTERVALS), F.lit(False))


def bars_between(bars: DataFrame, first: str, last: str) -> DataFrame:
    """Main-board bars of a range of dates, bounds included; on a table partitioned by date only those partitions are read."""
    return main_board(bars.where(F.col("trade_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))))


def bars_for_symbols(bars: DataFrame, symbols: DataFrame, until: str, lookback: int = 20) -> DataFrame:
    """Bars of the listed symbols in the 2 * lookback calendar days up to a date, with the close before."""
    end = F.lit(until).cast("date")
    known = symbols.select(symbol_key(F.col("symbol")).alias("symbol")).distinct()
    rows = bars.where(F.col("trade_date").between(F.date_sub(end, 2 * lookback), end)).join(known, "symbol", "left_semi")
    return rows.withColumn("prev_close", previous(F.col("close"), series()))


def latest_bars(bars: DataFrame, n: int) -> DataFrame:
    """The last n bars of every symbol."""
    nth = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("day")))
    return bars.withColumn("nth", nth).where(F.col("nth") <= n).drop("nth")


def bars_for_pairs(bars: DataFrame, pairs: DataFrame) -> DataFrame:
    """Bars of exactly the (symbol, trade_date) pairs asked for."""
    return bars.join(pairs.select("symbol", "trade_date").distinct(), ["symbol", "trade_date"], "left_semi")


def feature_lookup(features: DataFrame, pairs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """pairs (symbol, trade_date) with one column for each named feature of the long form; null where there is none."""
    keys = ["symbol", "trade_date"]
    value = lambda n: F.when(F.col("feature_name") == n, F.col("value"))
    asked = pairs.select(*keys).distinct()
    known = features.where(F.col("feature_name").isin(*names)).join(asked, keys, "left_semi")  # what isn't asked for is neither sorted nor kept
    wide = known.groupBy(*keys).agg(*[F.max(value(n)).alias(n) for n in names])
    return asked.join(wide, keys, "left")


def last_dates(df: DataFrame, n: int, overlap: DataFrame | None = None) -> DataFrame:
    """The n latest dates, oldest first, with those of ``overlap`` added."""
    dates = df.select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(n)
    if overlap is not None:
        dates = dates.unionByName(overlap.select("trade_date")).distinct()
    return dates.orderBy("trade_date")


def tallied(df: DataFrame, column: str) -> DataFrame:
    """How often each value of a column is there; MISSING for null."""
    return df.groupBy(F.coalesce(F.col(column), F.lit("MISSING")).alias(column)).agg(F.count("*").alias("n"))


def extras(df: DataFrame, canonical: tuple[str, ...]) -> Column:
    """All other columns as one JSON object of typed scalars, by name."""
    parts = [F.concat(F.lit(f'"{c}":'), scalar_json(F.col(c).cast("string"))) for c in sorted(df.columns) if c not in canonical]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _entries(json: Column) -> Column:
    """The entries of a report list: its current day's, the previous day's and the future ones, in this order."""
    entry = "array<struct<file: string, tradingDate: string>>"
    parsed = F.from_json(json, f"CurrentDay {entry}, PreviousDay {entry}, FutureDay {entry}")
    none = F.array().cast(entry)
    return F.concat(*[F.coalesce(parsed[k], none) for k in ("CurrentDay", "PreviousDay", "FutureDay")])


def listed(json: Column, file: Column, day: Column) -> Column:
    """The entry of a report list with the file's name, else its first of the day; null if it has neither."""
    named = lambda es: F.filter(es, lambda e: e["file"] == file)
    dated = lambda es: F.filter(es, lambda e: e["tradingDate"] == F.date_format(day, "dd-MMM-yyyy"))
    return F.get(F.transform(F.array(_entries(json)), lambda es: F.coalesce(F.get(named(es), F.lit(0)), F.get(dated(es), F.lit(0)))), F.lit(0))


def report_entries(reports: DataFrame) -> DataFrame:
    """reports (json text with CurrentDay, PreviousDay and FutureDay lists) as rows: file, trading_date, seq."""
    rows = reports.select(*[c for c in reports.columns if c != "json"], F.posexplode(_entries(F.col("json"))).alias("seq", "e"))
    return rows.withColumns({"file": F.col("e.file"), "trading_date": F.try_to_date("e.tradingDate", "dd-MMM-yyyy")}).drop("e")


def matching_entry(entries: DataFrame, file: Column, day: Column, by: str) -> DataFrame:
    """The first entry with the file's name, else the first of the day, for each value of ``by``."""
    rank = F.when(F.col("file") == file, 0).when(F.col("trading_date") == day, 1)
    nth = F.row_number().over(Window.partitionBy(by).orderBy("rank", "seq"))
    return entries.withColumn("rank", rank).where("rank is not null").withColumn("nth", nth).where("nth = 1").drop("rank", "nth")


#: Columns that a file of candles must have.
CANDLE_COLUMNS = ("Open", "High", "Low", "Close", "Volume")


def candle_columns(df: DataFrame, keep: tuple[str, ...] = (), required: tuple[str, ...] = CANDLE_COLUMNS) -> DataFrame:
    """The required columns of a table of text, and those of ``keep``, as numbers; commas go. A missing one is an error."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"no column for {', '.join(missing)}")
    return df.select(*keep, *[number_text(F.col(c)).alias(c.lower()) for c in required])


def candle_file(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Candles of CSV files with a header."""
    return candle_columns(spark.read.csv(path, header=True), keep)


def staging_by_status(staging: DataFrame, status: str = "PENDING", limit: int | None = None, *ties: str) -> DataFrame:
    """Staging rows of a status, oldest first, the first ``limit`` of them if given."""
    rows = staging.where(F.col("validation_status") == status).orderBy("created_at", *ties)
    return rows if limit is None else rows.limit(limit)


def signals_of(signals: DataFrame, day: str) -> DataFrame:
    """Signals of one date; on a table partitioned by date only that partition is read."""
    return signals.where(F.col("trade_date") == F.lit(day).cast("date"))


def atr_at(means: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (symbol, ref_date) with atr: the last of means (symbol, trade_date, atr) before that date that isn't null."""
    known = means.select("symbol", "trade_date", F.lit(1).alias("side"), "atr")
    asked = asked.select("symbol", F.col("ref_date").alias("trade_date"), F.lit(0).alias("side"), F.lit(None).cast("double").alias("atr"))
    order = Window.partitionBy("symbol").orderBy("trade_date", "side")  # what is asked for a date comes before its bar
    rows = known.unionByName(asked).withColumn("atr", F.last("atr", True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("side = 0").select("symbol", F.col("trade_date").alias("ref_date"), "atr")
