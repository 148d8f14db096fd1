"""The first row ahead that reaches a barrier, however far ahead it is.

A chunk of a series has a sparse table: the largest high and the smallest low of 1, 2, 4, ... rows
from each row on. A row's first hit is found by going through it in growing and then shrinking
steps, stepping over blocks that hold none. What isn't found in its own chunk looks for the first later
chunk whose extremes reach a barrier, in a sparse table of the chunks, and then inside that one. Chunks
are spans of time, a series has one row a chunk, and rows that ask for one chunk come in blocks, so that
neither a series nor those that ask for its peak have to fit into a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.segments import CHUNK, chunk_table, chunked
from quotemill.sources.table_io import staged

#: Prices are compared as whole numbers of 10^-SCALE.
SCALE = 6
#: Chunks whose rows ask together.
BLOCK = 64
HIGHEST = np.iinfo(np.int64).max
#: What a search reads of a row.
SEARCHED = ("high_", "low_", "up_", "down_", "place", "tag")


def _tables(high: np.ndarray, low: np.ndarray, most: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The extremes of 1, 2, 4, ... rows from each row on, up to the first power that is ``most``; beyond the end there is nothing."""
    highs, lows, k = [high], [low], 1
    while k < min(most, len(high)):
        beyond = np.full(k, HIGHEST)
        highs.append(np.maximum(highs[-1], np.r_[highs[-1][k:], -beyond]))
        lows.append(np.minimum(lows[-1], np.r_[lows[-1][k:], beyond]))
        k *= 2
    return highs, lows


def first_hits(high: np.ndarray, low: np.ndarray, at: np.ndarray, up: np.ndarray, down: np.ndarray, most: int | None = None) -> np.ndarray:
    """For each query the first place from ``at`` on with high >= up or low <= down; the number of rows if there is none. most: rows that a search goes through, where that is known."""
    highs, lows = _tables(high, low, len(high) if most is None else most)
    n, at = len(high), np.minimum(at, len(high)).copy()
    for k in [*range(len(highs)), *range(len(highs) - 1, -1, -1)]:
        live = np.flatnonzero(at < n)
        miss = live[(highs[k][at[live]] < up[live]) & (lows[k][at[live]] > down[live])]
        at[miss] = np.minimum(at[miss] + (1 << k), n)
    return at


def _longs(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy().astype(np.int64) for c in names]


def _maybe(values: np.ndarray, missing: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=missing)


def _solved(rows: pa.Table) -> pa.Table:
    """Whole series, one after another, with the tag of the first later row of its series that each one's search hits, null if there is none. A row of its own after each series stops every search."""
    high, low, up, down, place, tag = _longs(rows, *SEARCHED)
    starts = np.flatnonzero(place == 0)
    nth = np.cumsum(place == 0) - 1
    at = np.arange(len(place)) + nth
    total = len(place) + len(starts)
    highs, lows, tags = np.full(total, HIGHEST), np.full(total, -HIGHEST), np.zeros(total, np.int64)
    highs[at], lows[at], tags[at] = high, low, tag
    stops = np.r_[at[starts[1:]] - 1, total - 1]
    found = first_hits(highs, lows, at + 1, up, down, int(place.max()) + 2)
    return rows.append_column("hit", _maybe(tags[found], found == stops[nth]))


def _hits(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The named columns of rows in order of their series and place (from 0) with hit; the last series of a batch waits for the next one."""
    held: list[pa.Table] = []
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        starts = np.flatnonzero(rows.column("place").to_numpy() == 0)
        if len(starts):
            if before := [t for t in (*held, rows.slice(0, starts[-1])) if t.num_rows]:
                yield from _solved(pa.concat_tables(before).combine_chunks()).select(names).to_batches()
            held, rows = [], rows.slice(starts[-1])
        held.append(rows)
    if any(t.num_rows for t in held):
        yield from _solved(pa.concat_tables(held).combine_chunks()).select(names).to_batches()


def _searched(df: DataFrame, keys: list[str], *order: str, keep: list[str] | None = None) -> DataFrame:
    """df with place in the series of the keys, and hit. Series follow one another in a task, so that Python is called by batches of rows and not by series.

    keep: the columns that are wanted with place and hit, so that no other goes through Python.
    """
    place = (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long")
    df = df.withColumn("place", place).sortWithinPartitions(*keys, *order)  # as the window leaves them
    df = df if "tag" in df.columns else df.withColumn("tag", F.col("place"))
    kept = [*(df.columns if keep is None else [*keep, "place"]), "hit"]
    df = df if keep is None else df.select(*keep, *SEARCHED)
    types = dict([*df.dtypes, ("hit", "long")])
    return df.mapInArrow(lambda batches: _hits(batches, kept), ", ".join(f"`{c}` {types[c]}" for c in kept))


def with_steps(rows: DataFrame, by: list[str], order: str, high: str, low: str, up: Column, down: Column, width: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """rows with steps: how many rows ahead in its series is the first whose high reaches ``up`` or whose low reaches ``down``; null if none does.

    keep: the columns of rows that are wanted, all by default.

    width: a chunk's span of time in ``order``; without one a series is one chunk, as for daily bars.
    Rows without a barrier have no steps by it; a missing high or low reaches nothing. ``order`` is unique
    in a series and not null.
    """
    whole = lambda c, missing: F.coalesce((c.cast("decimal(24,6)") * 10**SCALE).cast("long"), F.lit(missing))
    df = rows.withColumns({"high_": whole(F.col(high), -HIGHEST), "low_": whole(F.col(low), HIGHEST), "up_": whole(up, HIGHEST), "down_": whole(down, -HIGHEST)})
    if width is None:
        return _searched(df, by, order, keep=keep).select(*rows.columns if keep is None else keep, (F.col("hit") - F.col("place")).alias("steps"))
    own = staged(_searched(chunked(df, order, width), [*by, CHUNK], order), "barriers")
    table = chunk_table(own, by, F.max("high_").alias("chunk_high"), F.min("low_").alias("chunk_low"))
    table = table.select(*by, CHUNK, F.col("nth").cast("long").alias("nth"), (F.col("upto") - F.col("n")).alias("start"), "chunk_high", "chunk_low")
    block = F.floor((F.col("nth") - 1) / BLOCK)
    asks = F.col("hit").isNull() & ((F.col("up_") < HIGHEST) | (F.col("down_") > -HIGHEST))
    number = lambda n: F.lit(n).cast("long")
    never_hit, never_ask = {"high_": number(-HIGHEST), "low_": number(HIGHEST)}, {"up_": number(HIGHEST), "down_": number(-HIGHEST)}
    open_ = own.where(asks).join(table.select(*by, CHUNK, "nth", "start"), [*by, CHUNK])
    open_ = open_.select(*rows.columns, "up_", "down_", (F.col("start") + F.col("place")).alias("row"), F.col("nth").alias("tag"), block.alias("block"), F.lit(True).alias("asks")).withColumns(never_hit)
    blocks = table.groupBy(*by).agg(F.max(block).alias("last"))
    shown = table.join(blocks, by).select(*by, F.col("nth").alias("tag"), F.col("chunk_high").alias("high_"), F.col("chunk_low").alias("low_"), F.explode(F.sequence(number(0), F.col("last"))).alias("block"), F.lit(False).alias("asks"))
    aimed = _searched(open_.unionByName(shown.withColumns(never_ask), allowMissingColumns=True), [*by, "block"], "tag", "asks")  # a chunk, and then the rows of it that ask
    aimed = staged(aimed.where("asks and hit is not null").drop("place", "tag").withColumnRenamed("hit", "target"), "aimed")
    pairs = aimed.select(*by, F.col("target").alias("nth"), "block").distinct()
    inside = own.select(*by, CHUNK, "place", "high_", "low_").join(table.select(*by, CHUNK, "nth", "start"), [*by, CHUNK]).join(pairs, [*by, "nth"])
    inside = inside.select(*by, F.col("nth").alias("target"), "block", (F.col("start") + F.col("place")).alias("tag"), "high_", "low_", F.lit(False).alias("asks"))
    late = _searched(aimed.withColumn("tag", number(-1)).unionByName(inside.withColumns(never_ask), allowMissingColumns=True), [*by, "target", "block"], "tag")  # all that ask, and then the chunk
    late = late.where("asks").select(*rows.columns, (F.col("hit") - F.col("row")).alias("steps"))
    rest = own.join(aimed.select(*by, order), [*by, order], "left_anti")
    return rest.select(*rows.columns, (F.col("hit") - F.col("place")).alias("steps")).unionByName(late).select(*rows.columns if keep is None else keep, "steps")
