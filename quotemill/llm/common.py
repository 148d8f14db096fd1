"""What several operators share: reading, cutting lineage, free column names, components of a graph."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.sources.table_io import shared_dir, table

#: ASCII white space separates words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table at path, read again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, and a lost executor costs no recomputation.

    The table stays as long as the shared folder does, since the plans that read it may run later.
    """
    return written(df, new_path(df.sparkSession, name))


def removed(spark: SparkSession, path: str | None) -> None:
    """Deletes a table that no plan reads any more."""
    if path:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names that df doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts, joined by '|'; 52 bits, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an undirected graph, root being the smallest node reachable.

    Alternates two star contractions, each a grouped minimum joined back to its neighbours, and
    writes every round to the shared folder. Nodes without an edge to another node don't appear.
    """
    spark = edges.sparkSession
    path, mark = new_path(spark, "edges"), None
    pairs = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), path)
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        before, path = path, new_path(spark, "edges")
        pairs = written(small.distinct(), path)
        removed(spark, before)
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
