import random

import duckdb
from pyspark.sql import functions as F

from quotemill.llm.url_filter import LISTED, RULES, URL_SQL, build_cascade, default_list, in_cascade, url_verdicts

URLS = [
    "http://A.Example.NET/en/x",
    "https://example.net/en",
    "https://example.net/en/",
    "http://notexample.net/en/",
    "http://example.com/de/x?q=1#f",
    "http://sub.example.com/fr/",
    "http://x.org/fr/1",
    "http://org/fr/",
    "http://net/",
    "http://net",
    "http://www.spam-farm.example.org/en/1",
    "http://spam-farm.example.org.evil.com/",
    "http://SPAM-FARM.example.com?x=/",
    "ftp://user@host:80/p#a://b",
    "no scheme",
    "",
    None,
    "://",
    "://ÄÖ.net/",
    "a://b\n.net/x\ny?z",
]


def judged(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if any(host == k or host.endswith("." + k) for k in LISTED) else "allow"


def pages(spark):
    return spark.createDataFrame([(k, u, "page") for k, u in enumerate([*URLS, URLS[0]])] + [(None, URLS[4], None)], "page_id long, url string, host string")


def test_verdicts_against_brute_force_and_sql(spark):
    df = pages(spark)
    want = sorted(((r["page_id"], *judged(r["url"])) for r in df.collect()), key=str)
    assert sorted(map(tuple, url_verdicts(df, default_list(spark)).collect()), key=str) == want
    assert sorted(map(tuple, url_verdicts(df, default_list(spark), max_keys=3).collect()), key=str) == want
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    got = con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({URL_SQL})").fetchall()
    assert sorted(((None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:]) for r in got), key=str) == want


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(1)
    keys = {f"host{rng.randrange(10**9)}.example" for _ in range(4000)}
    listed = {k for k in keys if rng.random() < 0.1}
    levels = build_cascade(spark.createDataFrame([(k, k in listed) for k in keys], "key string, listed boolean"))
    assert len(levels) > 1
    df = spark.createDataFrame([(k, k in listed) for k in keys], "key string, listed boolean")
    assert df.where(in_cascade(F.col("key"), levels) != F.col("listed")).count() == 0
    assert sum(x.bits for x in levels) < 32 * len(listed)


def test_nothing_listed_and_no_pages(spark):
    none = spark.createDataFrame([], "key string")
    assert url_verdicts(pages(spark), none).where("rule is null and verdict = 'block'").count() == 0
    assert url_verdicts(pages(spark).limit(0), default_list(spark)).count() == 0
    odd = spark.createDataFrame([(None,), ("",), ("example.com",), ("example.com",)], "key string")
    assert url_verdicts(pages(spark), odd).where("host = 'sub.example.com'").first()["verdict"] == "block"


def test_many_cascades_are_exact(spark):
    """Keys dealt to cascades of a few: exactly the listed ones are told, whatever the parts."""
    from quotemill.llm.url_filter import build_cascades, listed_keys

    rows = [(f"h{k}.example.com", k % 7 == 0) for k in range(3000)]
    keys = spark.createDataFrame(rows, "key string, listed boolean")
    for size in (32, 10_000):
        cascades, parts = build_cascades(keys, size)
        assert parts == -(-sum(x for _, x in rows) // size)
        assert {r["key"] for r in listed_keys(keys, cascades, parts).collect()} == {k for k, x in rows if x}
    none, parts = build_cascades(keys.where("not listed"))
    assert listed_keys(keys, none, parts).count() == 0
    every, parts = build_cascades(keys.where("listed"), 64)
    assert listed_keys(keys.where("listed"), every, parts).count() == sum(x for _, x in rows)


def test_very_long_urls(spark):
    pages = spark.createDataFrame([(1, "http://" + "a." * 20_000 + "example.net/en/" + "x" * 50_000), (2, "http://" + "b" * 100_000), (3, "x" * 100_000)], "page_id long, url string")
    for most in (0, 100):
        got = {r["page_id"]: (len(r["host"]), r["rule"], r["verdict"]) for r in url_verdicts(pages, default_list(spark), max_keys=most).collect()}
        assert got == {1: (40_011, "example.net/en/", "allow"), 2: (100_000, None, "allow"), 3: (0, None, "allow")}
