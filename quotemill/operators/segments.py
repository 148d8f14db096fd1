"""Windows over series too long for one task: cut in chunks of time, with what each needs from before.

Frames of some rows get a halo, the last rows before a chunk, carried over as rows of the chunk and
dropped after. Running sums are made in two passes: sums inside a chunk, and the sums of the chunks
before. What is passed on is a row a chunk, and the tails of chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "chunk"


def chunked(rows: DataFrame, order: str = "ts", width: str = "7 days") -> DataFrame:
    """rows with the start of their chunk; rows without a time have none, and no series."""
    return rows.where(F.col(order).isNotNull()).withColumn(CHUNK, F.window(F.col(order).cast("timestamp"), width)["start"])


def chunk_table(rows: DataFrame, by: list[str], *sums: Column) -> DataFrame:
    """A row a chunk: its number in its series, its rows, and how many rows there are up to its end."""
    found = rows.groupBy(*by, CHUNK).agg(F.count("*").alias("n"), *sums)
    w = Window.partitionBy(*by).orderBy(CHUNK) if by else Window.partitionBy(F.lit(0)).orderBy(CHUNK)  # a row a chunk
    return found.withColumns({"nth": F.row_number().over(w), "upto": F.sum("n").over(w)})


def with_halo(rows: DataFrame, by: list[str], need: int, order: str = "ts") -> DataFrame:
    """Chunked rows and, as rows of each chunk with halo = true, the ``need`` rows before it; times are unique in a series."""
    chunks = chunk_table(rows, by)
    w = Window.partitionBy(*by, CHUNK).orderBy(F.desc(order))
    tails = rows.withColumn("from_end", F.row_number().over(w)).where(F.col("from_end") <= need)
    tails = tails.join(chunks.select(*by, CHUNK, "nth", "upto"), [*by, CHUNK]).drop(CHUNK)
    # at most ``need`` chunks later, since every chunk has a row
    tails = tails.withColumn("for_nth", F.explode(F.sequence(F.col("nth") + 1, F.col("nth") + need)))
    later = chunks.select(*by, CHUNK, F.col("nth").alias("for_nth"), (F.col("upto") - F.col("n")).alias("before"))
    halo = tails.join(later, [*by, "for_nth"]).where(F.col("before") - F.col("upto") + F.col("from_end") <= need)
    return rows.withColumn("halo", F.lit(False)).unionByName(halo.select(*rows.columns, F.lit(True).alias("halo")))


def over_chunks(rows: DataFrame, by: list[str], need: int, body, order: str = "ts", width: str = "7 days") -> DataFrame:
    """body(rows, keys) with a window's rows by chunk: body computes over frames of ``need`` rows before by partitioning by ``keys``."""
    out = body(with_halo(chunked(rows, order, width), by, need, order), [*by, CHUNK])
    return out.where("not halo").drop("halo", CHUNK)


def running(rows: DataFrame, by: list[str], sums: dict[str, Column], order: str = "ts", width: str = "7 days") -> DataFrame:
    """rows with running sums from the start of their series, by name; nulls count for nothing, and a sum of nothing is null."""
    rows = chunked(rows, order, width).withColumns({f"{name}_of": c for name, c in sums.items()})
    chunks = chunk_table(rows, by, *[F.sum(f"{name}_of").alias(f"{name}_sum") for name in sums])
    w = Window.partitionBy(*by).orderBy(CHUNK) if by else Window.partitionBy(F.lit(0)).orderBy(CHUNK)  # a row a chunk
    before = chunks.select(*by, CHUNK, *[F.sum(f"{name}_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(f"{name}_before") for name in sums])
    inside = Window.partitionBy(*by, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({name: F.sum(f"{name}_of").over(inside) for name in sums}).join(before, [*by, CHUNK])
    total = lambda name: F.when(F.col(name).isNull() & F.col(f"{name}_before").isNull(), F.lit(None)).otherwise(F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"{name}_before"), F.lit(0)))
    return rows.withColumns({name: total(name) for name in sums}).drop(CHUNK, *[f"{name}_{x}" for name in sums for x in ("of", "before")])
