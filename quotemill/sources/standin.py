"""Bars, candles and instruments made from the driver's tables, which hold no market data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.sources.table_io import table

CENTS = 10**14
#: Rows that a task has of a shuffle by symbol, so that its memory doesn't grow with the tables.
PART_ROWS = 500_000


def symbol_of(supplier: str) -> Column:
    """The symbol of a supplier's number."""
    return F.concat(F.lit("S"), F.col(supplier))


def bars(spark: SparkSession, sf_dir: str, named: bool = True) -> DataFrame:
    """Daily bars: lineitem by supplier and ship date.

    Few rows share a day, so that sums before the shuffle would save nothing: rows are dealt by symbol,
    which the days and all windows of a symbol then go by without another shuffle. The first and last
    price are those of the least and largest (order, line, price); rows are sorted for them by symbol
    and day, as the windows want them, and no task holds its days in memory. Prices stay what they are:
    only those that CENTS is too small for are counted in cents, and wrap. Without names symbol is the
    supplier's number, which costs less to deal, to sort and to keep; symbol_of() names it in the result.
    """
    lines = table(spark, sf_dir, "lineitem")
    parts = max(spark.sparkContext.defaultParallelism, -(-lines.count() // PART_ROWS))
    rows = lines.select(
        (symbol_of("l_suppkey") if named else F.col("l_suppkey")).alias("symbol"),
        F.unix_date(F.to_date("l_shipdate")).alias("day"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )
    key = F.when(F.col("seq").isNotNull() & F.col("price").isNotNull(), F.struct("seq", "price"))
    wrapped = lambda p: (F.pmod((p * 100).cast("bigint"), F.lit(CENTS)).cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    price_of = lambda c: F.when((c["price"] >= 0) & (c["price"] < CENTS // 100), c["price"]).otherwise(wrapped(c["price"]))
    days = rows.repartition(parts, "symbol").groupBy("symbol", "day").agg(
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("price").alias("value"),
        F.sum("qty").alias("net_trdqty"),
        F.count("*").alias("trades"),
    )
    supplier = F.substring("symbol", 2, 20).cast("bigint") if named else F.col("symbol")
    return days.select(
        "symbol",
        F.date_from_unix_date("day").alias("trade_date"),
        "day",
        price_of(F.col("first_key")).alias("open"),
        "high",
        "low",
        price_of(F.col("last_key")).alias("close"),
        F.col("value").cast("decimal(24,2)").alias("net_trdval"),
        "net_trdqty",
        "trades",
        F.when(supplier % 10 == 9, 1).otherwise(0).alias("mkt_flag"),
        F.when(supplier % 7 == 6, "Y").otherwise("N").alias("ind_sec"),
    )


BARS_SQL = """bars AS (
  SELECT symbol, trade_date, ((first_key % 100000000000000)::DECIMAL(18,2) / 100)::DECIMAL(18,2) AS open, high, low,
    ((last_key % 100000000000000)::DECIMAL(18,2) / 100)::DECIMAL(18,2) AS close, net_trdval, net_trdqty, trades, mkt_flag, ind_sec
  FROM (
    SELECT 'S' || l_suppkey AS symbol, l_shipdate::DATE AS trade_date,
      min((l_orderkey * 8 + l_linenumber)::HUGEINT * 100000000000000 + (l_extendedprice::DECIMAL(18,2) * 100)::BIGINT) AS first_key,
      max((l_orderkey * 8 + l_linenumber)::HUGEINT * 100000000000000 + (l_extendedprice::DECIMAL(18,2) * 100)::BIGINT) AS last_key,
      max(l_extendedprice::DECIMAL(18,2)) AS high, min(l_extendedprice::DECIMAL(18,2)) AS low,
      sum(l_extendedprice::DECIMAL(18,2)) AS net_trdval, sum(l_quantity::BIGINT)::BIGINT AS net_trdqty, count(*) AS trades,
      max(CASE WHEN l_suppkey % 10 = 9 THEN 1 ELSE 0 END) AS mkt_flag, max(CASE WHEN l_suppkey % 7 = 6 THEN 'Y' ELSE 'N' END) AS ind_sec
    FROM lineitem GROUP BY 1, 2))"""


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute candles of one instrument: events by tumbling window, price being the value; session is the date."""
    rows = table(spark, sf_dir, "events").select("ts", "event_id", F.col("value").cast("decimal(18,4)").alias("price"))
    return candles_of(rows)


def candles_of(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """ts, event_id, price, by -> by, ts (start of the window), open, high, low, close, volume, session."""
    start = F.window("ts", "5 minutes")["start"]
    order = F.struct("ts", "event_id")
    out = rows.where("ts is not null and price is not null").groupBy(*by, start.alias("start")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.count("*").alias("volume")
    )
    return out.select(*by, F.to_date("start").alias("session"), F.col("start").alias("ts"), "open", "high", "low", "close", "volume")


CANDLES_SQL = """candles AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts)::DATE AS session, time_bucket(INTERVAL 5 MINUTE, ts) AS ts,
    arg_min(value::DECIMAL(18,4), row(ts, event_id)) AS open, max(value::DECIMAL(18,4)) AS high, min(value::DECIMAL(18,4)) AS low,
    arg_max(value::DECIMAL(18,4), row(ts, event_id)) AS close, count(*) AS volume
  FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2)"""
