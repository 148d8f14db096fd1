import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from quotemill.llm.registry import ORACLE, QUERIES
from quotemill.llm.secrets import MASK

VOCABULARY = [f"{a}{b}{c}" for a in ("pa", "lo", "mi", "ker") for b in ("ta", "ren", "sol") for c in ("", "s", "do", "ing")]


def body(seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=200))


def tables(spark, path):
    rows = [(i, body(i), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100, rows[0][1], "en", "s0", 1), (101, rows[0][1].replace(" ", "  "), "en", "s0", 1), (102, "too short", "en", "s1", 1), (103, None, None, None, None), (104, f"{body(104)} password=e3b3ed3cc8548923d6 {body(105)}", "en", "s1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.mode("overwrite").parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_stages_follow_each_other(spark, tmp_path):
    path = str(tmp_path)
    docs = tables(spark, path)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, path)
        if name != "pack_sequences":
            assert docs.columns == before.columns
        docs.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert 102 not in seen["quality_rules"] and 103 not in seen["quality_rules"] and len(seen["quality_rules"]) == 63
    assert 100 not in seen["near_copies"] and 101 not in seen["near_copies"] and 0 in seen["near_copies"]
    assert sorted(seen["secret_scan"]) == sorted(seen["near_copies"])
    masked = spark.read.parquet(f"{path}/secret_scan").where("doc_id = 104").first()["text"]
    assert MASK in masked and "e3b3" not in masked
    assert Counter(seen["mix_sources"]).keys() <= set(seen["secret_scan"])
    assert corpus_pipeline.run(spark, path).agg(F.sum("length")).first()[0] == docs.agg(F.sum("length")).first()[0]


def test_empty_documents(spark, tmp_path):
    tables(spark, str(tmp_path)).limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES if n != "pipeline"} == {f"op{k}" for k in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)
