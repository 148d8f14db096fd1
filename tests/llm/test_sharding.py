import bisect
import zlib

import pytest
from pyspark.sql import functions as F

from quotemill.llm import sharding
from quotemill.llm.sharding import shard_records, shard_report


def check(rows, shards=8):
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(0 <= r["shard"] < shards for r in rows)


def test_shards_are_even_and_equal_texts_stay_together(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.md5((F.col("id") % 4000).cast("string")), (F.col("id") % 4000 % 7 + 1).cast("int")).alias("text"))
    rows = shard_report(df).collect()
    check(rows)
    size = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(size) < 1.01 * min(size)
    where = {}
    for r in rows:
        where.setdefault(r["doc_id"] % 4000, set()).add(r["shard"])
    assert all(len(x) == 1 for x in where.values())
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in rows:
        assert r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())


def test_a_hot_text_is_divided(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot " * 50).otherwise(F.repeat(F.md5(F.col("id").cast("string")), 6)).alias("text"))
    rows = shard_report(df).collect()
    check(rows)
    size = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(size) < 1.05 * min(size)


def test_odd_tables(spark, odd_docs, no_docs):
    df = odd_docs.withColumn("shard", F.lit("mine")).withColumn("key_hash", F.lit(1))
    out = shard_records(df, names={"shard": "to_shard"})
    assert set(df.columns) < set(out.columns)
    rows = shard_report(odd_docs).collect()
    check(rows)
    assert len(rows) == odd_docs.count() and {r["law"] for r in rows} == {"bytes"}
    assert shard_report(no_docs).count() == 0


def test_repeated_rows_are_divided(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot " * 40)).otherwise(F.repeat(F.md5(F.col("id").cast("string")), 5)).alias("text"))
    got = shard_report(rows).collect()
    check(got)
    assert len(got) == 4000
    size = [sum(r["size"] for r in got if r["shard"] == s) for s in range(8)]
    assert max(size) < 1.05 * min(size)


def test_against_a_plain_sharder(spark, odd_docs, monkeypatch):
    """The same splitters, applied by plain loops."""
    kept = []
    monkeypatch.setattr(sharding, "splitters_of", lambda *a, old=sharding.splitters_of, **k: kept.append(old(*a, **k)) or kept[-1])
    df = odd_docs.select("doc_id", "text").unionByName(spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.md5((F.col("id") % 900).cast("string")), (F.col("id") % 900 % 9).cast("int")).alias("text")))
    got = sorted((str(r["doc_id"]), r["size"], r["shard"], r["slot"]) for r in shard_report(df).collect())
    cuts, _ = kept[0]
    rows = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    keyed = sorted((r["h"], sharding.LOWEST if r["doc_id"] is None else r["doc_id"], 0, str(r["doc_id"]), len((r["text"] or "").encode()) + 1) for r in rows)
    ranges = {}
    for k in keyed:
        ranges.setdefault(bisect.bisect_right(cuts, k[:3]), []).append(k)
    total, before, want, slots = sum(k[4] for k in keyed), 0, [], [0] * 8
    for r in sorted(ranges):
        own = sum(k[4] for k in ranges[r])
        shard = min(7, (2 * before + own) * 8 // (2 * total))
        for k in ranges[r]:
            want.append((k[3], k[4], shard, slots[shard]))
            slots[shard] += 1
        before += own
    # rows with one key stand in either order
    assert sorted((i, n, s) for i, n, s, _ in want) == sorted((i, n, s) for i, n, s, _ in got) and sorted((s, t) for _, _, s, t in want) == sorted((s, t) for _, _, s, t in got)
    unique = {i for i, *_ in want if sum(x[0] == i for x in want) == 1}
    assert [x for x in sorted(want) if x[0] in unique] == [x for x in got if x[0] in unique]


def test_what_cannot_be_divided_is_told(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_quantiles", lambda *a: set())
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"), F.col("id").alias("i"), F.lit(0).cast("long").alias("j"), F.lit(9).cast("long").alias("size"))
    with pytest.warns(UserWarning, match="overfull"):
        sharding.splitters_of(keys, 45000)
