"""Company names as join keys, and dates in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings that are removed wherever they stand, one after the other, in this order.
ENDINGS = (" LTD", " LIMITED", " PVT", " PVT LTD", " PVT.LTD", " PRIVATE", " (I)", " INDIA", " LTD.", " LIMITED.")
MARKS = r"[.,'\"/\\&\-–]"


def light_key(c: Column) -> Column:
    """Upper case, without what is in parentheses, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.trim(c)), r"\([^)]*\)", " "), r"\s+", " "))


def name_key(c: Column) -> Column:
    """light_key without punctuation and ENDINGS; empty for null."""
    key = F.regexp_replace(F.regexp_replace(F.upper(F.trim(F.coalesce(c, F.lit("")))), r"\([^)]*\)", " "), MARKS, " ")
    for ending in ENDINGS:
        key = F.replace(key, F.lit(ending), F.lit(" "))
    return F.trim(F.regexp_replace(key, r"\s+", " "))


def symbol_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def file_date(name: Column, last_year: Column | None = None) -> Column:
    """The date in a file name: 8 digits as YYYYMMDD, then DDMMYYYY; 6 digits as DDMMYY, then MMDDYY.

    Two digits are a year of this century up to ``last_year`` (five years from now unless given), and of the last one beyond.
    """
    last_year = F.year(F.current_date()) + 5 if last_year is None else last_year
    eight, six = F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit("")), F.nullif(F.regexp_extract(name, r"(\d{6})", 1), F.lit(""))
    day = lambda text, year, month, day_: F.try_to_date(F.concat_ws("-", year(text), month(text), day_(text)), "yyyy-MM-dd")
    cut = lambda a, n: lambda t: F.substring(t, a, n)
    short = lambda t: F.concat(F.when(F.substring(t, 5, 2).cast("int") <= last_year % 100, F.lit("20")).otherwise(F.lit("19")), F.substring(t, 5, 2))
    ymd = day(eight, cut(1, 4), cut(5, 2), cut(7, 2))
    plausible = F.year(ymd).between(1990, 2100)
    return F.coalesce(F.when(plausible, ymd), day(eight, cut(5, 4), cut(3, 2), cut(1, 2)), day(six, short, cut(3, 2), cut(1, 2)), day(six, short, cut(1, 2), cut(3, 2)))


def loose_date(c: Column) -> Column:
    """ISO, with slashes, or day first."""
    text = F.trim(c)
    return F.coalesce(*[F.try_to_date(text, f) for f in ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy", "dd-MMM-yyyy")])
