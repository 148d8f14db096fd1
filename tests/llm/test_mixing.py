import hashlib
import math

import duckdb
from pyspark.sql import functions as F

from quotemill.llm.mixing import MIX_REPORT_SQL, SEED, mix_report, mix_sources, mixed, source_rates


def number(*parts):
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16) / float(1 << 52)


def inverted(mean, u):
    p = c = math.exp(-mean)
    k = 0
    while c <= u and k < mean + 12 * math.sqrt(mean) + 20:
        k += 1
        p *= mean / k
        c += p
    return k


def test_counts_against_brute_force(spark, odd_docs):
    rows = odd_docs.select("doc_id", "source", "text").collect()
    size = {}
    for r in rows:
        size[r["source"]] = size.get(r["source"], 0) + len((r["text"] or "").encode()) + 1
    share = {s: math.floor(math.sqrt(b) * 1000) for s, b in size.items()}
    rate = {s: share[s] / sum(share.values()) * (sum(size.values()) / size[s]) for s in size}
    want = {}
    for r in rows:
        digest = hashlib.md5((r["text"] or "").encode()).hexdigest()
        own = (str(SEED), "" if r["doc_id"] is None else str(r["doc_id"]), digest)
        n = inverted(rate[r["source"]], number(*own, "1"))
        want[(r["doc_id"], digest)] = want.get((r["doc_id"], digest), 0) + n
    got = {}
    for r in mix_report(odd_docs).collect():
        got[(r["doc_id"], r["text_md5"])] = got.get((r["doc_id"], r["text_md5"]), 0) + 1
        assert abs(r["rate"] - rate[r["source"]]) < 1e-12 and r["copy"] < r["n_copies"]
    assert got == {k: n for k, n in want.items() if n}


def test_sql_gives_the_same_rows(spark, odd_docs):
    con = duckdb.connect()
    con.register("documents", odd_docs.where("doc_id is not null").toPandas())
    cols = ["doc_id", "source", "rate", "n_copies", "copy", "shuffle_key", "text_md5"]
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({MIX_REPORT_SQL})").fetchall()
    got = mix_report(odd_docs.where("doc_id is not null")).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_weights_are_met_on_average(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("source"), F.lit("x" * 9).alias("text"))
    out = mixed(df, weights={"small": 0.5, "large": 0.5})
    assert out.columns == df.columns
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["small"] - 10_000) < 500 and abs(n["large"] - 10_000) < 500


def test_large_means_are_drawn_in_parts(spark):
    df = spark.range(10_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 0, "one").otherwise("rest").alias("source"), F.lit("x").alias("text"))
    rates = {r["source"]: r for r in source_rates(df, weights={"one": 0.9, "rest": 0.1}).collect()}
    assert rates["one"]["parts"] == math.ceil(rates["one"]["rate"] / 500) > 1
    n = mix_sources(df, weights={"one": 0.9, "rest": 0.1}).where("source = 'one'").count()
    assert abs(n - 9000) < 500


def test_clashing_columns_and_empty_tables(spark, odd_docs, no_docs):
    df = odd_docs.withColumn("rate", F.lit("r")).withColumn("copy", F.lit("c")).withColumn("cdf", F.lit("d"))
    out = mixed(df)
    assert out.columns == df.columns and {r["copy"] for r in out.collect()} <= {"c"}
    assert mix_report(no_docs).count() == 0 and mixed(no_docs).count() == 0
