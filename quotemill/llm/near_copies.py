"""Near copies: documents whose sets of word shingles have a Jaccard similarity of at least a bound.

SimHash fingerprints of the same shingles, searched in BK-trees, find the copies that differ little:
fingerprints within RADIUS bits are candidates. Two texts at the bound (0.8) differ in about 10 of 64
bits, and no radius that trees can be searched with reaches those. So there are candidates by MinHash
bands as well: a pair at the bound shares none of BANDS bands of BAND_ROWS with a probability of
0.00007, a closer pair with less. Every link is an exact similarity of two sets.

Texts with the same words are one node from the start. Pairs from the trees, and in each band's
bucket each node with the node before it and the first one, are tried first: their number is in
proportion to the nodes, however large a group is. Then buckets whose nodes aren't all of one group
are compared whole, block by block: a block is so many nodes and shingles at most, and what two
blocks share is one product of matrices. A task gives back no more pairs than tie groups together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import components, free, shared_dir, staged
from quotemill.llm.simhash import SEED, links, majority, shingle_hashes, words_of

SHINGLE, SIMILARITY = 5, 0.8
RADIUS = 3
BANDS, BAND_ROWS = 24, 5
#: Nodes and shingles of a block; columns of a matrix; nodes of a band that stand in one row of neighbours.
BLOCK_NODES, BLOCK_SHINGLES, COLUMNS, LINE_NODES = 1024, 1 << 20, 4096, 4096

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SUMMANDS = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)


def bands_of(shingles: np.ndarray) -> list[int]:
    """A hash for each band of the sketch, as signed longs; none for an empty set."""
    if not len(shingles):
        return []
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(least, ((shingles[at : at + 1024, None] * _FACTORS + _SUMMANDS) >> np.uint64(32)).min(axis=0), out=least)
    hashes = [xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, BAND_ROWS))]
    return np.array(hashes, np.uint64).view(np.int64).tolist()


def _sketch(text: Column) -> Column:
    """struct<node, n, fp, bands>: a hash of the words, the number of distinct shingles, the fingerprint and the bands."""

    @F.pandas_udf("node binary, n int, fp long, bands array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            words = words_of(t)
            hashes = shingle_hashes(words, SHINGLE)
            shingles = np.unique(hashes)
            fp = majority(hashes)
            rows.append((xxhash.xxh128_digest(b" ".join(words), SEED), len(shingles), fp - (fp >> 63 << 64), bands_of(shingles)))
        return pd.DataFrame(rows, columns=["node", "n", "fp", "bands"])

    return of(text)


def _shingle_set(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(words_of(t), SHINGLE)).view(np.int64) for t in texts], dtype=object)

    return of(text)


def _alike(a: Column, b: Column, similarity: float) -> Column:
    """Whether sets of such sizes can be as similar."""
    return F.least(a, b) / F.greatest(a, b) >= similarity


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size(F.array_intersect("x", "y")).alias("both"), (F.size("x") + F.size("y")).alias("sum"))
    return both.where(F.col("both") / (F.col("sum") - F.col("both")) >= similarity).select("a", "b")


def similarities(sets: list[np.ndarray]) -> np.ndarray:
    """The Jaccard similarity of every two of some sets."""
    size = np.array([len(s) for s in sets])
    which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    place = np.cumsum(times > 1) - 1  # what only one set has is in no intersection
    owner, column = np.repeat(np.arange(len(sets)), size)[times[which] > 1], place[which[times[which] > 1]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        both += part @ part.T
    both = both.astype(np.float64)
    return both / np.maximum(size[:, None] + size[None] - both, 1)


def _ties(roots: list[bytes], sets: list[np.ndarray], similarity: float) -> list[tuple[bytes, bytes]]:
    """Pairs of roots with nodes that are similar enough."""
    code, names = pd.factorize(np.array(roots, object))
    i, j = np.nonzero((similarities(sets) >= similarity) & (code[:, None] < code[None]))
    return [(min(names[x], names[y]), max(names[x], names[y])) for x, y in np.unique(np.stack([code[i], code[j]], axis=1), axis=0)]


def _compared(similarity: float):
    """Over rows sorted by bucket and blocks, the pairs of groups that belong together."""
    keys = ["band", "i", "j"]

    def done(rows: pd.DataFrame) -> pd.DataFrame:
        band, i, j = (rows[k].to_numpy() for k in keys)
        cuts = np.flatnonzero((band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        edges = [0, *cuts.tolist(), len(rows)]
        roots, sets = rows["root"].tolist(), rows["shingles"].tolist()
        pairs = {p for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1 for p in _ties(roots[a:b], sets[a:b], similarity)}
        return pd.DataFrame(sorted(pairs), columns=["a", "b"], dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if not len(rows):
                continue
            other = np.flatnonzero((rows[keys] != rows[keys].iloc[-1]).any(axis=1))
            last = int(other[-1]) + 1 if len(other) else 0  # the last block may go on in the next batch
            held = rows.iloc[last:].reset_index(drop=True)
            if last:
                yield done(rows.iloc[:last])
        if held is not None and len(held):
            yield done(held)

    return run


def near_copy_groups(sketches: DataFrame, texts, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(node, root) for the nodes linked to another one. sketches: node, n, fp, bands; texts(nodes): node and text for a table of nodes."""
    # by fingerprints
    prints = sketches.where("n > 0").select("node", "n", "fp").distinct()
    heads = staged(prints.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("head")), "heads")
    head = lambda x: heads.select(F.col("fp").alias(x), F.col("head").alias(f"of_{x}"))
    close = links(heads.select("fp"), radius, direct=True).join(head("a"), "a").join(head("b"), "b").select(F.col("of_a").alias("x"), F.col("of_b").alias("y"))
    close = close.unionByName(prints.join(heads, "fp").select(F.struct("node", "n").alias("x"), F.col("head").alias("y")))
    # by bands
    rows = sketches.select("node", "n", F.explode("bands").alias("band")).distinct()
    # a band's head is a grouped minimum, and its nodes stand in lines of about LINE_NODES, so that a large bucket is many tasks
    entry = F.struct("node", "n")
    held = rows.groupBy("band").agg(F.count("*").alias("m"), F.min(F.struct(F.xxhash64("band", "node").alias("h"), "node", "n")).alias("head")).where("m > 1")
    rows = rows.join(held.select("band", "m", F.struct("head.node", "head.n").alias("head")), "band")
    rows = rows.withColumn("line", F.pmod(F.xxhash64("node", F.lit(2)), F.ceil(F.col("m") / LINE_NODES)))
    order = Window.partitionBy("band", "line").orderBy(F.xxhash64("band", "node"), "node")  # other neighbours in every bucket
    rows = rows.select("band", "node", "n", F.coalesce(F.lag(entry).over(order), "head").alias("before"), "head")
    members = staged(rows, "buckets")
    near = members.select(entry.alias("x"), F.explode(F.array_distinct(F.array("before", "head"))).alias("y")).unionByName(close)
    near = near.where((F.col("x.node") != F.col("y.node")) & _alike(F.col("x.n"), F.col("y.n"), similarity))
    near = staged(near.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "pairs")
    nodes = members.select("node").union(near.select("a")).union(near.select("b")).distinct()
    sets = staged(texts(nodes).select("node", _shingle_set(F.col("text")).alias("shingles")), "shingles")
    linked = staged(_verified(near, sets, similarity), "links")
    # what is left: buckets whose nodes aren't of one group
    placed = members.select("band", "node", "n").join(components(linked, "a", "b"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("size")).where("lo <> hi")
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_NODES, F.col("size") / BLOCK_SHINGLES))
    placed = placed.join(mixed.select("band", blocks.alias("blocks")), "band").join(sets, "node").withColumn("at", F.pmod(F.xxhash64(F.col("node"), F.lit(1)), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = placed.select("band", "root", "shingles", "at", other.alias("with")).select("band", F.least("at", "with").alias("i"), F.greatest("at", "with").alias("j"), "root", "shingles")
    ties = placed.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInPandas(_compared(similarity), "a binary, b binary")
    return components(linked.unionByName(ties), "a", "b")


def near_copy_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each group of near copies: the one with the smallest id (null ids last), then the smallest MD5 of its text.

    Rows with the same id and text count as copies too; one of them stays. Null texts count as
    empty texts and form one group, with all texts without words. All columns of docs are kept.
    """
    shared_dir(docs.sparkSession)
    key, same, keep_id, keep_key = free(docs, "text_key", "n_same", "keep_id", "keep_key")
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    thin = staged(keyed.select(F.col(id_col).alias("id"), F.col(key).alias("key"), _sketch(F.col(text_col)).alias("s")).select("id", "key", "s.*"), "sketches")
    first = thin.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("best"))

    def texts(nodes: DataFrame) -> DataFrame:
        ask = first.join(nodes, "node").select("node", F.col("best.id").alias("id"), F.col("best.key").alias("key"))
        have = keyed.select(F.col(id_col).alias("have_id"), F.col(key).alias("have_key"), F.col(text_col).alias("text"))
        return have.join(ask, F.col("have_id").eqNullSafe(F.col("id")) & (F.col("have_key") == F.col("key"))).select("node", "text").dropDuplicates(["node"])

    groups = near_copy_groups(thin, texts, similarity)
    best = first.join(groups, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best")).select("best.id", "best.key")
    counts = thin.groupBy("id", "key").agg(F.count("*").alias(same))
    best = best.join(counts, best["id"].eqNullSafe(counts["id"]) & (best["key"] == counts["key"])).select(best["id"].alias(keep_id), best["key"].alias(keep_key), same)
    kept = keyed.join(best, F.col(id_col).eqNullSafe(F.col(keep_id)) & (F.col(key) == F.col(keep_key)))
    once = kept.where(F.col(same) == 1).select(*docs.columns)
    return once.unionByName(kept.where(F.col(same) > 1).dropDuplicates([keep_id, key]).select(*docs.columns))
