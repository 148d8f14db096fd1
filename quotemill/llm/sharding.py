"""Sharding by sampled splitters.

A record's key is the hash of its text, then its id, so that equal texts lie side by side and a
group of copies of any size can still be divided. Where rows that are repeated, id and all, fill
more than a range, records are written out first with a third part of the key, a hash of their
place in the table. Keys are sampled with probability in proportion
to size; quantiles of the sample cut the keys in ranges, at the edge of a group wherever the group
isn't hot. Ranges that turn out overfull are sampled again by themselves and divided. Runs of
consecutive ranges then make the shards, and records are numbered range by range.
"""

from __future__ import annotations

import warnings
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import free, staged, unit_hash

SHARDS = 8
#: Ranges aimed at, at least, and bytes of a range; more ranges than MAX_RANGES are never aimed at, so that the splitters stay within a megabyte.
MIN_RANGES, RANGE_BYTES, MAX_RANGES = 2048, 256 << 20, 65536
#: Sampled keys for each range.
PER_RANGE = 16
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
KEY = ("h", "i", "j")
KeyOf = tuple[int, int, int]


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _keys(*parts: np.ndarray) -> np.ndarray:
    """(h, i, j) as 24 bytes that sort like the three."""
    both = np.stack(parts, axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(both.astype(">u8")).view("S24").reshape(-1)


def range_of(key: list[Column], splitters: list[KeyOf]) -> Column:
    """How many splitters are at or below the key."""
    table = _keys(*np.array(splitters or [(0, 0, 0)], np.int64).T)[: len(splitters)]

    @F.pandas_udf("int")
    def of(h: pd.Series, i: pd.Series, j: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(table, _keys(h.to_numpy(), i.to_numpy(), j.to_numpy()), side="right").astype(np.int32))

    return of(*key)


def _quantiles(sample: list[KeyOf], n: int) -> set[KeyOf]:
    """At most n - 1 splitters at even places of the sorted sample, each at its group's edge unless the group is a hot one there."""
    out = set()
    for k in range(1, n):
        h, i, j = sample[k * len(sample) // n]
        first, after = (h, LOWEST, LOWEST), (h + 1, LOWEST, LOWEST)
        hi = bisect_left(sample, after) if h < HIGHEST else len(sample)
        hot = (hi - bisect_left(sample, first)) * n > 2 * len(sample)
        out |= {(h, i, j), first} | ({after} if h < HIGHEST else set()) if hot else {first}
    return out


def even_share(total: int) -> tuple[int, int]:
    """How many ranges are aimed at, and the bytes of each."""
    ranges = int(min(MAX_RANGES, max(MIN_RANGES, total // RANGE_BYTES)))
    return ranges, max(1, total // ranges)


def splitters_of(keys: DataFrame, total: int, stalls: int = 4) -> tuple[list[KeyOf], list[tuple[int, int, int]]]:
    """Splitters over keys (h, i, j, size), and (range, bytes, rows) for the ranges that have rows.

    Overfull ranges are divided until there is none but those of one record or one key. Where
    sampling finds no new splitter so many times over, a warning names what is left.
    """
    ranges, even = even_share(total)

    def sampled(rows: DataFrame, seed: int) -> list[tuple]:
        """About PER_RANGE keys for each ``even`` bytes, a record's chance in proportion to its size."""
        chance = F.col("size") * F.lit(PER_RANGE / even)
        return rows.where(unit_hash(F.lit(str(seed)), *[F.col(k).cast("string") for k in KEY]) < chance).collect()

    first = sorted(tuple(r[k] for k in KEY) for r in sampled(keys.select(*KEY, "size"), 0))
    cuts = sorted(_quantiles(first, ranges)) if first else []
    seed = stalled = 0
    while True:
        placed = keys.withColumn("range", range_of([F.col(k) for k in KEY], cuts))
        sizes = [(r["range"], r["bytes"], r["n"], r["one"]) for r in placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), (F.min(F.struct(*KEY)) == F.max(F.struct(*KEY))).alias("one")).collect()]
        full = {r: b for r, b, _, one in sizes if b > 2 * even and not one}
        if not full or stalled == stalls:
            break
        seed += 1
        again: dict[int, list[KeyOf]] = {}
        for row in sampled(placed.where(F.col("range").isin(list(full))).select(*KEY, "size", "range"), seed):
            again.setdefault(row["range"], []).append(tuple(row[k] for k in KEY))
        more = {s for r, got in again.items() for s in _quantiles(sorted(got), -(-full[r] // even))} - set(cuts)
        stalled = 0 if more else stalled + 1
        cuts = sorted(set(cuts) | more)
    if full:
        warnings.warn(f"{len(full)} ranges stay overfull, the largest with {max(full.values())} bytes of {even}", stacklevel=2)
    return cuts, sorted((r, b, n) for r, b, n, _ in sizes)


def assign(sizes: list[tuple[int, int, int]], shards: int = SHARDS) -> dict[int, tuple[int, int]]:
    """range -> (shard, rows of the shard before it): each range goes where the middle of its bytes lies."""
    total, before, out, rows = sum(b for _, b, _ in sizes) or 1, 0, {}, [0] * shards
    for r, b, n in sizes:
        shard = min(shards - 1, int((2 * before + b) * shards // (2 * total)))
        out[r] = (shard, rows[shard])
        rows[shard] += n
        before += b
    return out


def shard_records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, names: dict[str, str] | None = None) -> DataFrame:
    """docs, range-partitioned, with size, shard and slot (gapless from 0 in each shard); shards are near equal in bytes.

    Equal texts share a shard, but for groups that are hot (more than twice a range), which are
    divided by id, and by place where rows are repeated as often. Null ids sort first, null texts count as empty, repeated rows are records of
    their own. An empty table gives an empty result.
    """
    out = {c: c for c in ("size", "shard", "slot")} | (names or {})
    h, i, j, r, base = free(docs, "key_hash", "key_id", "key_place", "range_of", "base_of")
    hashed, ident = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))
    columns = {out["size"]: size_of(F.col(text_col)), h: hashed, i: ident}
    thin = staged(docs.select(hashed.alias("h"), ident.alias("i"), F.lit(0).cast("long").alias("j"), size_of(F.col(text_col)).alias("size")), "keys")
    total = thin.agg(F.sum("size")).first()[0] or 0
    df = docs.withColumns(columns | {j: F.lit(0).cast("long")})
    repeated = thin.groupBy("h", "i").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("bytes") > 2 * even_share(total)[1]))
    if not repeated.isEmpty():
        df = staged(docs.withColumns(columns | {j: F.xxhash64(F.monotonically_increasing_id())}), "records")  # a place is the same to all that read it
        thin = df.select(F.col(h).alias("h"), F.col(i).alias("i"), F.col(j).alias("j"), F.col(out["size"]).alias("size"))
    cuts, sizes = splitters_of(thin, total)
    places = assign(sizes, shards)
    top = max(places, default=-1) + 1
    lookup = lambda k, kind: F.split(F.lit(",".join(str(places.get(x, (0, 0))[k]) for x in range(top)) or "0"), ",").cast(f"array<{kind}>")
    df = df.withColumn(r, range_of([F.col(h), F.col(i), F.col(j)], cuts))
    local = F.row_number().over(Window.partitionBy(r).orderBy(h, i, j)) - 1
    df = df.withColumn(base, local.cast("long")).withColumn(out["shard"], F.get(lookup(0, "int"), F.col(r))).withColumn(out["slot"], F.get(lookup(1, "bigint"), F.col(r)) + F.col(base))
    return df.drop(h, i, j, r, base)


def shard_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law (bytes), shard, slot and grown_shard (null) for each row of docs."""
    df = shard_records(docs.select("doc_id", "text"))
    return df.select("doc_id", "size", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
