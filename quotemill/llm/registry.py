"""The queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from quotemill.llm.alignment import aligned_documents
from quotemill.llm.ann import search_report
from quotemill.llm.centroids import CENTROIDS_SQL, clusters
from quotemill.llm.common import read
from quotemill.llm.mixing import MIX_REPORT_SQL, mix_report
from quotemill.llm.packing import packed_documents
from quotemill.llm.pii import personal_data
from quotemill.llm.quality import quality_report
from quotemill.llm.secrets import secret_report
from quotemill.llm.sharding import shard_report
from quotemill.llm.simhash import simhash_components
from quotemill.llm.site_quality import site_quality
from quotemill.llm.toxicity import toxicity
from quotemill.llm.url_filter import URL_SQL, default_list, url_verdicts


def op1_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_report(read(spark, sf_dir, "embeddings"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read(spark, sf_dir, "pages"), default_list(spark))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(read(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_documents(read(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_site_quality": op1_site_quality,
    "op2_ann": op2_ann,
    "op3_simhash": op3_simhash,
    "op4_url_filter": op4_url_filter,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_secrets": op7_secrets,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_sharding": op10_sharding,
    "op11_pii": op11_pii,
    "op12_alignment": op12_alignment,
    "op13_centroids": op13_centroids,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op4_url_filter": URL_SQL,
    "op5_mixing": MIX_REPORT_SQL,
    "op13_centroids": CENTROIDS_SQL,
}
