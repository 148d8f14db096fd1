"""URL filters: host and path rules, then an exact block list held in a cascade of Bloom filters.

The first filter has the listed keys. The second has the keys of the corpus that aren't listed and
that the first lets through by mistake, the third the listed keys that the second mistakes, and so
on until a filter makes no mistake over all keys of the corpus. Walking the filters then gives
exact membership for every key of the corpus, without a join. Filters are a few bits for each
listed key, whatever the number of pages; they travel as literals in the plan. The keys of a list of
more than ``MAX_KEYS`` are dealt by hash to many small cascades, rows of a table in the shared folder
that the corpus's distinct keys meet by their number: the same filters, levels and verdicts.

DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict); a rule fits its host and all below it, if the path starts with the rule's.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Block-listed domains, with all hosts below them.
LISTED = tuple(f"{name}.example.{end}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for end in ("com", "net", "org"))
#: Keys up to which the list is held in filters: some 4 MB of literals at 10 to 14 bits a key.
MAX_KEYS = 2_500_000
MAX_LEVELS = 64
#: Listed keys of one of many cascades: a filter of about a kilobyte.
PART_KEYS = 512


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, with A-Z lower-cased; empty for null or no ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty for null or no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (n, rule, verdict), or null; of equally long ones the last by name."""
    fits = [
        F.when(((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in rules
    ]
    return F.array_max(F.filter(F.array(*fits), lambda x: x.isNotNull()))


def domains(host: Column, most: int) -> Column:
    """The host and the domains above it that have at most so many labels; none for an empty host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.greatest(F.lit(1), n - (most - 1)), n), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)).cast("long") for i in range(hashes)]


def _passes(key: Column, at: int, level: Level) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")
    out = F.lit(True)
    for place in _places(key, at, level.bits, level.hashes):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        shifted = F.call_function("shiftright", word, place.bitwiseAND(F.lit(63)).cast("int"))
        out = out & (shifted.bitwiseAND(F.lit(1).cast("long")) == 1)
    return out


def _filter(keys: DataFrame, at: int, n: int, rate: float) -> Level:
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 64) * 64)
    hashes = max(1, round(bits / n * math.log(2)))
    places = keys.select(F.explode(F.array(*_places(F.col("key"), at, bits, hashes))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    words = [0] * (bits // 64)
    for row in places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        words[row["word"]] = row["bits"]
    return Level(bits, hashes, tuple(words))


def build_cascade(keys: DataFrame) -> list[Level]:
    """keys: distinct ``key`` of the corpus with ``listed``. Filters that decide every one of them."""
    table = staged(keys.select("key", "listed"), "keys")
    counts = {r["listed"]: r["n"] for r in table.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    levels: list[Level] = []
    into, others = table.where("listed").select("key"), table.where("not listed").select("key")
    n, m = counts.get(True, 0), counts.get(False, 0)
    while n and len(levels) < MAX_LEVELS:
        rate = 0.5 if levels else min(0.5, max(n / math.sqrt(2) / max(m, 1), 1e-9))
        level = _filter(into, len(levels), n, rate)
        wrong = staged(others.where(_passes(F.col("key"), len(levels), level)), "mistaken")
        levels.append(level)
        into, others, n, m = wrong, into, wrong.count(), n
    if n:
        raise RuntimeError("the cascade did not end")
    return levels


def in_cascade(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the corpus is listed."""
    out = F.lit(len(levels) % 2 == 1)
    for at in range(len(levels) - 1, -1, -1):
        out = F.when(~_passes(key, at, levels[at]), F.lit(at % 2 == 1)).otherwise(out)
    return out


def _of_parts(key: Column, at: Column, bits: Column, hashes: Column, words: Column) -> Column:
    """Whether a key passes the filter in the columns."""

    def bit(i: Column) -> Column:
        place = F.pmod(F.xxhash64(key, at, i), bits)
        return F.call_function("shiftright", F.get(words, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1

    return F.forall(F.sequence(F.lit(0), hashes - 1), bit)


def _filters(into: DataFrame, others: DataFrame, level: int) -> DataFrame:
    """part, bits, hashes, words of a level's filters: of the keys in ``into``, against those in ``others``."""
    n, m = (df.groupBy("part").agg(F.count("*").alias(c)) for df, c in ((into, "n"), (others, "m")))
    rate = F.lit(0.5) if level else F.least(F.lit(0.5), F.greatest(F.col("n") / math.sqrt(2) / F.greatest(F.coalesce("m", F.lit(0)), F.lit(1)), F.lit(1e-9)))
    sizes = n.join(m, "part", "left").select("part", "n", F.greatest(F.lit(1), F.ceil(-F.col("n") * F.ln(rate) / math.log(2) ** 2 / 64)).cast("long").alias("long"))
    sizes = sizes.select("part", (F.col("long") * 64).alias("bits"), F.greatest(F.lit(1), F.round(F.col("long") * 64 / F.col("n") * math.log(2)).cast("int")).alias("hashes"))
    places = into.join(sizes, "part").select("part", F.explode(F.transform(F.sequence(F.lit(0), F.col("hashes") - 1), lambda i: F.pmod(F.xxhash64("key", F.lit(level), i), F.col("bits")))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    held = places.select("part", F.shiftright("place", 6).cast("int").alias("word"), bit.alias("bits_"))
    none = sizes.select("part", F.explode(F.sequence(F.lit(0), (F.col("bits") / 64).cast("int") - 1)).alias("word"), F.lit(0).cast("long").alias("bits_"))
    words = held.unionByName(none).groupBy("part", "word").agg(F.bit_or("bits_").alias("bits_")).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("word", "bits_"))).alias("w"))
    return sizes.join(words.select("part", F.col("w.bits_").alias("words")), "part")


def build_cascades(keys: DataFrame, part_keys: int = PART_KEYS) -> tuple[DataFrame, int]:
    """(part, levels of each, number of parts) for distinct ``key`` of the corpus with ``listed``; keys are dealt by hash."""
    table = staged(keys.select("key", "listed"), "keys")
    parts = max(1, math.ceil(table.where("listed").count() / part_keys))
    dealt = table.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), F.col("key")), F.lit(parts)))
    into, others, levels = dealt.where("listed").select("part", "key"), dealt.where("not listed").select("part", "key"), []
    while not into.isEmpty():
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascades did not end")
        at = len(levels)
        filters = staged(_filters(into, others, at), "filters")
        levels.append(filters.withColumn("level", F.lit(at)))
        wrong = others.join(filters, "part").where(_of_parts(F.col("key"), F.lit(at), F.col("bits"), F.col("hashes"), F.col("words"))).select("part", "key")
        into, others = staged(wrong, "mistaken"), into
    if not levels:
        return table.sparkSession.createDataFrame([], "part long, levels array<struct<level:int,bits:bigint,hashes:int,words:array<bigint>>>"), parts
    whole = levels[0]
    for df in levels[1:]:
        whole = whole.unionByName(df)
    return staged(whole.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("level", "bits", "hashes", "words"))).alias("levels")), "cascades"), parts


def listed_keys(keys: DataFrame, cascades: DataFrame, parts: int) -> DataFrame:
    """key: those of the corpus's keys that are listed, by the cascades of their parts."""
    dealt = keys.select("key", F.pmod(F.xxhash64(F.lit("part"), F.col("key")), F.lit(parts)).alias("part")).join(cascades, "part")
    stops = F.filter("levels", lambda x: ~_of_parts(F.col("key"), x["level"], x["bits"], x["hashes"], x["words"]))
    first = F.array_min(F.transform(stops, lambda x: x["level"]))
    return dealt.where(F.coalesce(first, F.size("levels")) % 2 == 1).select("key")


def url_verdicts(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, max_keys: int = MAX_KEYS) -> DataFrame:
    """One row for each row of pages: page_id, host, path, rule (null if none fits), verdict (allow or block).

    listed: block-listed domains in column ``key``; null and empty keys count for nothing. A page
    without a fitting rule is blocked if its host or a domain above it is listed. A null url, or
    one without ://, has empty host and path: no rule fits and nothing is listed, so it is allowed.
    Repeated rows come out as often as they came in; other columns aren't looked at.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    hosts = rows.select("host").distinct()
    names = listed.where("key is not null and key <> ''").select("key").distinct()
    most = names.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 1  # what has more labels than any listed key isn't listed
    keys = hosts.select(F.explode(domains(F.col("host"), most)).alias("key")).distinct()
    keys = keys.join(names.withColumn("listed", F.lit(True)), "key", "left").withColumn("listed", F.col("listed").isNotNull())
    if names.count() <= max_keys:
        levels = build_cascade(keys)
        judged = rows.withColumn("blocked", F.exists(domains(F.col("host"), most), lambda k: in_cascade(k, levels)))
    else:
        cascades, parts = build_cascades(keys)
        bad = hosts.select("host", F.explode(domains(F.col("host"), most)).alias("key")).join(listed_keys(keys, cascades, parts), "key", "left_semi").select("host").distinct()
        judged = rows.join(bad.withColumn("blocked", F.lit(True)), "host", "left").withColumn("blocked", F.col("blocked").isNotNull())
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return judged.withColumn("fit", fit).select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))


def default_list(spark) -> DataFrame:
    return spark.createDataFrame([(k,) for k in LISTED], "key string")


_NAMES = ", ".join(f"('{k}')" for k in LISTED)
_FITS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
URL_SQL = f"""
WITH urls AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), parts AS (SELECT DISTINCT host, path FROM urls
), rules(h, p, v) AS (VALUES {_FITS}
), best AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path
), listed(k) AS (VALUES {_NAMES}
), bad AS (SELECT DISTINCT host FROM parts JOIN listed ON host = k OR ends_with(host, '.' || k))
SELECT u.page_id, u.host, u.path, b.rule, coalesce(b.verdict, CASE WHEN u.host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u LEFT JOIN best b USING (host, path)
"""
