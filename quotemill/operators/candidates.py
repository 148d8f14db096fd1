"""Candidates from a day's archive: movers, circuit hitters and turnover leaders, merged by symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.coerce import number_text
from quotemill.functions.names import light_key, name_key, symbol_key
from quotemill.sources.archive import projected

#: Order in which sources are merged.
SOURCES = {"circuit": 0, "gainer_loser": 1, "top_turnover": 2}


def movers(rows: DataFrame, threshold: float = 2.0, top: int = 50, by: tuple[str, ...] = ("trade_date",)) -> DataFrame:
    """Rows (security, pct, row_seq) that moved by the threshold or are among the ``top`` movers of the day; the first of each security.

    Rows over the threshold come before the others, then the order of the file counts.
    """
    size = F.abs("pct")
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(size.desc_nulls_last(), "row_seq"))
    over = F.coalesce(size >= threshold, F.lit(False))
    df = rows.withColumn("over", over).withColumn("nth", nth).where(F.col("over") | (F.col("nth") <= top))
    first = F.row_number().over(Window.partitionBy(*by, "security").orderBy(F.col("over").desc(), "row_seq"))
    return df.withColumn("first", first).where("first = 1").drop("over", "nth", "first")


def turnover_leaders(rows: DataFrame, top: int = 20, by: tuple[str, ...] = ("trade_date",)) -> DataFrame:
    """The ``top`` rows of the day by value, then quantity, then order of the file."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("value").desc_nulls_last(), F.col("qty").desc_nulls_last(), "row_seq"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= top).drop("nth")


def merged(parts: DataFrame) -> DataFrame:
    """parts (trade_date, symbol, reason, row_seq, pct, last_price, prev_close, turnover, status) by day and symbol.

    Prices and percentages are the first that aren't null in the order circuit, movers, turnover;
    the status the last. Reasons are sorted, the first is the primary one.
    """
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in SOURCES.items() for x in pair]), F.col("reason"))
    order = rank.cast("long") * (1 << 40) + F.col("row_seq")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    df = parts.groupBy("trade_date", "symbol").agg(
        F.array_sort(F.collect_set("reason")).alias("reasons"),
        *[first(c) for c in ("pct", "prev_close", "last_price", "turnover")],
        F.max_by("status", F.when(F.col("status").isNotNull(), order)).alias("status"),
    )
    return df.select("trade_date", "symbol", F.array_join("reasons", ",").alias("reason_set"), F.col("reasons")[0].alias("primary_reason"), "pct", "prev_close", "last_price", "turnover", "status")


def first_mapping(names: DataFrame, key=name_key, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, name_key, symbol): the symbol of the first row (by row_seq) with each key; empty keys and symbols don't count."""
    df = names.select(*by, key(F.col("security")).alias("name_key"), symbol_key(F.col("symbol")).alias("symbol"), "row_seq").where("name_key <> '' and symbol <> ''")
    return df.groupBy(*by, "name_key").agg(F.min_by("symbol", "row_seq").alias("symbol"))


def mapped(rows: DataFrame, names: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """rows (security) with symbol: the mapped one (within ``by``), else the name key itself."""
    table = first_mapping(names, by=by)
    df = rows.withColumn("name_key", name_key(F.col("security"))).join(table, [*by, "name_key"], "left")
    return df.withColumn("symbol", F.coalesce("symbol", "name_key"))


def enriched(candidates: DataFrame, daily: DataFrame, prices: DataFrame) -> DataFrame:
    """candidates (symbol) with security, close and source, from the first of these that knows the symbol.

    pd: the daily file by symbol. pr_by_symbol: the price file by a security that is the symbol.
    pd_by_name: the daily file by its light name key. Else miss, with nulls.
    """
    pd = daily.groupBy(symbol_key(F.col("symbol")).alias("symbol_key")).agg(F.min_by(F.struct("security", "close"), "row_seq").alias("pd"))
    pr = prices.groupBy(symbol_key(F.col("security")).alias("symbol_key")).agg(F.min_by(F.struct("security", "close"), "row_seq").alias("pr"))
    by_name = daily.groupBy(light_key(F.col("security")).alias("symbol_key")).agg(F.min_by(F.struct("security", "close"), "row_seq").alias("by_name"))
    df = candidates.withColumn("symbol_key", symbol_key(F.col("symbol")))
    for rows in (pd, pr, by_name):
        df = df.join(rows, "symbol_key", "left")
    ways: list[tuple[str, Column]] = [("pd", F.col("pd")), ("pr_by_symbol", F.col("pr")), ("pd_by_name", F.col("by_name"))]
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in ways], F.lit("miss"))
    best = F.coalesce(*[c for _, c in ways])
    return df.select("symbol", best["security"].alias("security"), best["close"].alias("close"), source.alias("source"))


def in_master(candidates: DataFrame, master: DataFrame) -> DataFrame:
    """Candidates whose symbol the master has; all of them if the master is empty."""
    known = master.select(symbol_key(F.col("symbol")).alias("symbol_key")).distinct()
    if master.isEmpty():
        return candidates
    return candidates.withColumn("symbol_key", symbol_key(F.col("symbol"))).join(known, "symbol_key", "left_semi").drop("symbol_key")


def missing_from(master: DataFrame, candidates: DataFrame) -> DataFrame:
    """Symbols of the master that no candidate has."""
    known = lambda df: df.select(symbol_key(F.col("symbol")).alias("symbol")).distinct()
    return known(master).join(known(candidates), "symbol", "left_anti")


#: Columns of the members of a daily archive, by synonyms.
MOVERS = {"security": ("SECURITY",), "pct": ("PERCENT_CG", "PERCENT_CHG"), "last_price": ("CLOSE_PRIC", "CLOSE_PRICE"), "prev_close": ("PREV_CL_PR",)}
HITTERS = {"security": ("SECURITY",), "status": ("NEW_STATUS", "NEW")}
LEADERS = {"security": ("SECURITY",), "value": ("NET_TRDVAL", "NET_TRD_VAL"), "qty": ("NET_TRDQTY", "NET_TRD_QTY")}
SYMBOLS = {"security": ("SECURITY",), "symbol": ("SYMBOL",)}


def from_archive(members: DataFrame, master: DataFrame, threshold: float = 2.0, top: int = 50, leaders: int = 20) -> DataFrame:
    """The candidates of each day, from its archive's members to those that the master has.

    Names become symbols by the day's own list; movers, circuit hitters and turnover leaders are
    chosen by security and merged by symbol.
    """
    kept = ("trade_date", "symbol", "reason", "row_seq", "pct", "last_price", "prev_close", "turnover", "status")
    numbers = lambda df, *cols: df.withColumns({c: number_text(F.col(c)) for c in cols})
    none = {"pct": "double", "last_price": "double", "prev_close": "double", "turnover": "double", "status": "string"}

    def part(df: DataFrame, reason: str) -> DataFrame:
        return df.withColumn("reason", F.lit(reason)).withColumns({c: F.lit(None).cast(t) for c, t in none.items() if c not in df.columns})

    moved = movers(numbers(projected(members, "GL", MOVERS), "pct", "last_price", "prev_close"), threshold, top)
    traded = turnover_leaders(numbers(projected(members, "TT", LEADERS), "value", "qty"), leaders).withColumn("turnover", F.col("value"))
    parts = [part(projected(members, "HL", HITTERS), "circuit"), part(moved, "gainer_loser"), part(traded, "top_turnover")]
    names = projected(members, "PD", SYMBOLS)
    parts = [p.select("security", *[c for c in kept if c != "symbol"]) for p in parts]
    return in_master(merged(mapped(parts[0].unionByName(parts[1]).unionByName(parts[2]), names, by=("trade_date",)).select(*kept)), master)
