"""Instrument master: staging, validation, change capture, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.functions.coerce import blank_to_null, security_in
from quotemill.functions.names import symbol_key

MARKETS, SERIES = ("N",), ("EQ",)
EXCHANGES = ("NFO", "NFO-OPT")
#: Fields whose changes are recorded.
TRACKED = ("series", "market_type", "mkt_flag", "include_in_bhav", "fno_flag", "source_file", "notes")


def staged_rows(rows: DataFrame, symbols: tuple[str, ...], series: tuple[str, ...], markets: tuple[str, ...], etfs: DataFrame | None = None) -> DataFrame:
    """symbol_raw, series_raw, market_type_raw, source_file, row_seq, other_raw (JSON of the other columns), is_etf.

    For each field the first of the synonyms that the table has. Rows without a symbol go; the
    first of each symbol and file stays.
    """
    have = {c.lower(): c for c in rows.columns}
    pick = lambda names: next((have[n.lower()] for n in names if n.lower() in have), None)
    found = {"symbol_raw": pick(symbols), "series_raw": pick(series), "market_type_raw": pick(markets)}
    rest = [c for c in rows.columns if c not in {*found.values(), "source_file", "row_seq"}]
    df = rows.select(
        *[(blank_to_null(F.col(c).cast("string")) if c else F.lit(None).cast("string")).alias(n) for n, c in found.items()],
        "source_file",
        "row_seq",
        F.to_json(F.struct(*[F.col(c) for c in sorted(rest)])).alias("other_raw") if rest else F.lit("{}").alias("other_raw"),
    ).where("symbol_raw is not null")
    if etfs is None:
        df = df.withColumn("is_etf", F.lit(False))
    else:
        df = df.withColumn("symbol_key", symbol_key(F.col("symbol_raw"))).join(etfs.select(symbol_key(F.col("symbol")).alias("symbol_key")).distinct().withColumn("is_etf", F.lit(True)), "symbol_key", "left").fillna({"is_etf": False}).drop("symbol_key")
    return keep_first(df, ["symbol_raw", "source_file"], "row_seq")


def keep_first(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return df.withColumn("nth_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("nth_ = 1").drop("nth_")


def keep_latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key; nulls come last, and so win."""
    return df.withColumn("nth_", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order]))).where("nth_ = 1").drop("nth_")


def staged_members(members: DataFrame) -> DataFrame:
    """Staging rows of the members of archives: symbol_raw, series_raw, market_type_raw, source_file, other_raw, is_etf, resolved.

    The fields that have no column of their own are other_raw. A row without a symbol gets that of
    its security by the archive's symbol list, the last one there, whatever the case. ETFs are told
    by symbol or security. The first row of each symbol and file stays; rows that still have no
    symbol stay once a file.
    """
    value = lambda *names: F.coalesce(*[blank_to_null(F.element_at("fields", n)) for n in names])
    known = ("SYMBOL", "SC_CODE", "SERIES", "MKT")
    file = F.regexp_extract("member", r"([^/\\]*)$", 1)
    low = lambda c: F.lower(F.trim(c))
    rows = members.select("archive", file.alias("source_file"), "kind", "row_seq", value("SYMBOL", "SC_CODE").alias("symbol_raw"), value("SERIES").alias("series_raw"), value("MKT").alias("market_type_raw"), F.map_filter("fields", lambda k, _: ~k.isin(*known)).alias("other"))
    rows = rows.withColumn("security", low(security_in(F.col("other"))))
    order = F.struct("source_file", "row_seq")
    names = rows.where("kind = 'PD' and security <> '' and symbol_raw is not null").groupBy("archive", "security").agg(F.max_by("symbol_raw", order).alias("by_name"))
    etf = rows.where("kind = 'ETF'")
    etf_symbols = etf.where("symbol_raw is not null").select("archive", F.col("symbol_raw").alias("symbol"), F.lit(True).alias("etf_symbol")).distinct()
    etf_names = etf.where("security <> ''").select("archive", "security", F.lit(True).alias("etf_name")).distinct()
    rows = keep_first(rows, ["archive", "symbol_raw", "source_file"], "row_seq")
    df = rows.join(names, ["archive", "security"], "left").withColumn("symbol", F.coalesce("symbol_raw", "by_name"))
    df = df.join(etf_symbols, ["archive", "symbol"], "left").join(etf_names, ["archive", "security"], "left")
    flag = F.coalesce("etf_symbol", F.lit(False)) | F.coalesce("etf_name", F.lit(False))
    return df.select("archive", F.col("symbol").alias("symbol_raw"), "series_raw", "market_type_raw", "source_file", F.to_json("other").alias("other_raw"), flag.alias("is_etf"), (F.col("symbol_raw").isNull() & F.col("symbol").isNotNull()).alias("resolved"))


def eligible(staging: DataFrame) -> DataFrame:
    """Rows that aren't ETFs, of an allowed market and series; the others stay pending."""
    return staging.where(~F.coalesce("is_etf", F.lit(False)) & F.upper(F.trim("market_type_raw")).isin(*MARKETS) & F.upper(F.trim("series_raw")).isin(*SERIES))


def validated(staging: DataFrame) -> DataFrame:
    """staging with parsed_symbol, include_in_bhav, errors and is_valid; only a missing symbol is an error."""
    ok = lambda c, allowed: F.coalesce(F.upper(F.trim(c)).isin(*allowed), F.lit(False))
    df = staging.withColumn("parsed_symbol", blank_to_null(F.col("symbol_raw")))
    df = df.withColumn("include_in_bhav", ~F.coalesce("is_etf", F.lit(False)) & ok("market_type_raw", MARKETS) & ok("series_raw", SERIES))
    errors = F.filter(F.array(F.when(F.col("parsed_symbol").isNull(), F.lit("no_symbol_resolved"))), lambda x: x.isNotNull())
    return df.withColumn("errors", F.concat_ws(",", errors)).withColumn("is_valid", F.col("errors") == "")


def changes(new: DataFrame, old: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """symbol, action (inserted, updated, no_change, skipped_no_symbol) and diff: changed fields as name:old>new, sorted, joined by ';'."""
    a = new.select("symbol", *[F.col(f).cast("string").alias(f"new_{f}") for f in fields])
    b = old.select(F.col("symbol").alias("old_symbol"), *[F.col(f).cast("string").alias(f"old_{f}") for f in fields])
    df = a.join(b, F.col("symbol") == F.col("old_symbol"), "left")
    text = lambda c: F.coalesce(F.col(c), F.lit("null"))
    parts = [F.when(~F.col(f"new_{f}").eqNullSafe(F.col(f"old_{f}")), F.concat(F.lit(f"{f}:"), text(f"old_{f}"), F.lit(">"), text(f"new_{f}"))) for f in sorted(fields)]
    diff = F.when(F.col("old_symbol").isNotNull(), F.concat_ws(";", *parts)).otherwise("")
    action = F.when(blank_to_null(F.col("symbol")).isNull(), "skipped_no_symbol").when(F.col("old_symbol").isNull(), "inserted").when(diff == "", "no_change").otherwise("updated")
    return df.select("symbol", action.alias("action"), diff.alias("diff"))


def index_futures(instruments: DataFrame, segments: tuple[str, ...] = ("NFO-FUT",)) -> DataFrame:
    """Futures on an index: of a derivatives exchange, with an expiry, NIFTY in name or symbol, no segment or an allowed one."""
    text = F.upper(F.concat_ws(" ", "name", "tradingsymbol"))
    free = blank_to_null(F.col("segment")).isNull() | F.upper(F.trim("segment")).isin(*segments)
    return instruments.where(F.upper(F.trim("exchange")).isin(*EXCHANGES) & (F.upper(F.trim("instrument_type")) == "FUT") & F.col("expiry").isNotNull() & text.contains("NIFTY") & free)


def nearest_contract(dates: DataFrame, contracts: DataFrame) -> DataFrame:
    """For each date the contract with the first expiry on or after it; ties go to the smaller token, then symbol.

    Contracts and dates are merged in one order and the next contract is carried back, so that no
    date is paired with more than one contract.
    """
    first = contracts.groupBy("expiry").agg(F.min(F.struct("token", "tradingsymbol")).alias("c"))
    both = dates.select(F.col("trade_date").alias("at"), F.lit(None).cast("date").alias("expiry"), F.lit(None).cast(dict(first.dtypes)["c"]).alias("c"), F.lit(0).alias("kind")).distinct()
    both = both.unionByName(first.select(F.col("expiry").alias("at"), "expiry", "c", F.lit(1).alias("kind")))
    year = F.year("at")
    years = both.groupBy(year.alias("y")).agg(F.min_by(F.struct("expiry", "c"), F.when(F.col("kind") == 1, F.col("at"))).alias("head"))
    years = years.withColumn("later", F.first("head", ignorenulls=True).over(Window.orderBy("y").rowsBetween(1, Window.unboundedFollowing)))  # a row a year
    w = Window.partitionBy("y").orderBy("at", "kind").rowsBetween(0, Window.unboundedFollowing)
    near = F.first(F.when(F.col("kind") == 1, F.struct("expiry", "c")), ignorenulls=True).over(w)
    df = both.withColumn("y", year).withColumn("near", near).where("kind = 0").join(years.select("y", "later"), "y", "left")
    best = F.coalesce("near", "later")
    return df.select(F.col("at").alias("trade_date"), best["expiry"].alias("expiry"), best["c"]["token"].alias("token"), best["c"]["tradingsymbol"].alias("tradingsymbol")).where("expiry is not null")
