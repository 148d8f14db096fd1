"""The corpus pipeline: quality rules, near copies, secrets, the mixture of sources, and packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the
last return the columns of docs. run() writes each stage's rows to the shared folder, so that a
lost executor costs at most the stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotemill.llm.common import new_path, read, removed, written
from quotemill.llm.mixing import mixed
from quotemill.llm.near_copies import near_copy_dedup
from quotemill.llm.packing import packed_documents
from quotemill.llm.quality import quality_filter
from quotemill.llm.secrets import mask_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality_filter(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked at a Jaccard similarity of 0.8 or more over 5-word shingles."""
    return near_copy_dedup(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts."""
    return mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for, in a global shuffle."""
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document's tokens with its place in a sequence."""
    return packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: MinHash, the forest and the tokenizer can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; a stage's table goes when the next one stands."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        docs = written(stage(spark, docs, sf_dir), path)
        removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
