"""SimHash near-dedup with BK-trees.

A text's fingerprint has 64 bits: a bit is set if it is set in over half the XXH64 hashes of the
text's word shingles. Fingerprints that differ in few bits are linked, and groups are the
components of those links.

Links are searched in BK-trees: a node's children are keyed by their Hamming distance to it, and a
search with radius r follows from a node at distance d only the edges d-r to d+r. All trees
together grow with the corpus, so they are not sent to every executor. Each shard's tree is sent
to the one task that has the fingerprints to be looked up there. Shards come from the pigeonhole
rule: with the bits cut in radius+2 blocks, two fingerprints within the radius agree on two blocks
at least, so a shard holds the fingerprints with the same bits in one pair of blocks. A shard with
more than ``tree_rows`` fingerprints is cut again by the same rule on the bits that are left.
After three cuts at the default radius 8 bits are left, so that no shard, however many near copies
there are, has more than max(tree_rows, 256) nodes, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import components, free, shared_dir, staged

SEED = 42
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased, as UTF-8."""
    return (text or "").translate(_LOWERED).encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """The XXH64 of each shingle of so many words, repeats included; a shorter text is one shingle, one without words none."""
    if not words:
        return np.empty(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)), np.uint64, len(words) - k + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as an unsigned integer; 0 for a text without words."""
    return majority(shingle_hashes(words_of(text), shingle))


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(text)


def _parts(bits: list[int], n: int) -> list[list[int]]:
    return [x.tolist() for x in np.array_split(np.array(bits), n)]


def masks(radius: int, levels: int = 3) -> list[dict[int, list[int]]]:
    """For each level, the masks that continue a mask: two of radius+2 blocks of its unset bits, set as well."""
    out, at = [], [0]
    for _ in range(levels):
        step = {}
        for mask in at:
            left = [b for b in range(64) if not mask >> b & 1]
            if len(left) < radius + 2:
                break
            step[mask] = [mask | sum(1 << b for part in pick for b in part) for pick in combinations(_parts(left, radius + 2), 2)]
        if not step:
            break
        out.append(step)
        at = list(dict.fromkeys(m for ms in step.values() for m in ms))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class BKTree:
    """Children keyed by integer Hamming distance to the parent."""

    __slots__ = ("values", "children")

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if self.values:
            at = 0
            while True:
                d = (self.values[at] ^ value).bit_count()
                if d == 0:
                    return
                down = self.children[at].get(d)
                if down is None:
                    self.children[at][d] = len(self.values)
                    break
                at = down
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(self.values[at])
            stack += [down for edge, down in self.children[at].items() if d - radius <= edge <= d + radius]
        return found


def _stars(values: list[int], radius: int, direct: bool = False) -> list[tuple[int, int]]:
    """(value, smallest value of its group) for the values of one shard that have a link there; direct: pairs within the radius that tie the groups."""
    tree, parent, pairs = BKTree(), {v: v for v in values}, []

    def top(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for v in values:
        for w in tree.within(v, radius):
            a, b = top(v), top(w)
            if a != b:
                pairs.append((v, w))
            parent[max(a, b)] = min(a, b)
        tree.add(v)
    return pairs if direct else [(v, r) for v in values if (r := top(v)) != v]


def _link(radius: int, direct: bool):
    """Over rows sorted by shard, (a, b) pairs that tie each shard's groups together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def done(rows: pd.DataFrame) -> pd.DataFrame:
            mask, bits, fp = (rows[c].to_numpy() for c in ("mask", "bits", "fp"))
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1
            pairs = [p for part in np.split(fp.view(np.uint64), cuts) if len(part) > 1 for p in _stars(part.tolist(), radius, direct)]
            return pd.DataFrame(np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if not len(rows):
                continue
            other = np.flatnonzero((rows["mask"] != rows["mask"].iloc[-1]) | (rows["bits"] != rows["bits"].iloc[-1]))
            last = int(other[-1]) + 1 if len(other) else 0  # the last shard may go on in the next batch
            held = rows.iloc[last:].reset_index(drop=True)
            if last:
                yield done(rows.iloc[:last].reset_index(drop=True))
        if held is not None and len(held):
            yield done(held)

    return run


def links(fingerprints: DataFrame, radius: int = 2, tree_rows: int = 2048, direct: bool = False) -> DataFrame:
    """(a, b) over distinct fingerprints in column fp, enough pairs to connect all that the radius connects; direct: only pairs within the radius."""
    steps = masks(radius)
    rows, ready = fingerprints.select("fp", F.lit(0).cast("long").alias("mask")), None
    for level, step in enumerate(steps):
        table = F.create_map(*[x for m, ms in step.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(y)) for y in ms]))])
        rows = rows.select("fp", F.explode(F.element_at(table, F.col("mask"))).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))
        if level:
            rows = rows.distinct()
        sizes = rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1")
        rows = rows.join(sizes, ["mask", "bits"])
        last = level + 1 == len(steps)
        fit = (rows if last else rows.where(F.col("n") <= tree_rows)).select("mask", "bits", "fp")
        ready = fit if ready is None else ready.unionByName(fit)
        rows = rows.where(F.col("n") > tree_rows).select("fp", "mask")
    return ready.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp").mapInPandas(_link(radius, direct), "a long, b long")


def near_groups(rows: DataFrame, radius: int = 2, tree_rows: int = 2048) -> DataFrame:
    """(fp, root) for the fingerprints of column fp that are linked to another one; root is one fingerprint of the group."""
    return components(links(rows.select("fp").distinct(), radius, tree_rows), "a", "b").select(F.col("node").alias("fp"), "root")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 lower-case hex digits), component_id.

    component_id is the smallest doc_id reachable over links, the row's own included. A null text
    counts as empty: its fingerprint is zero and linked like any other. Rows with a null doc_id
    are grouped like others but never give their group its id; a group of null ids only has none.
    Repeated rows come out as often as they came in. Other columns of docs aren't looked at. An
    empty table gives an empty result.
    """
    thin = staged(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle).alias("fp")), "fingerprints")
    least = thin.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = near_groups(least, radius)
    ids = least.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = ids.join(ids.where("least is not null").groupBy("root").agg(F.min("least").alias("component_id")), "root", "left").select("fp", "component_id")
    return thin.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """docs with one row of each group of near copies: the one with the smallest id (null ids last), then the smallest MD5 of its text.

    Rows with the same id and text count as copies too; one of them stays. Null texts count as
    empty texts and form one group, with all texts without words. All columns of docs are kept.
    """
    shared_dir(docs.sparkSession)
    key, same, keep_id, keep_key = free(docs, "text_key", "n_same", "keep_id", "keep_key")
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    thin = staged(keyed.select(F.col(id_col).alias("id"), F.col(key).alias("key"), fingerprint(F.col(text_col), shingle).alias("fp")), "fingerprints")
    groups = near_groups(thin, radius)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    best = thin.groupBy("fp").agg(F.min(order).alias("best"))
    best = best.join(groups, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best")).select("best.id", "best.key")
    counts = thin.groupBy("id", "key").agg(F.count("*").alias(same))
    best = best.join(counts, best["id"].eqNullSafe(counts["id"]) & (best["key"] == counts["key"])).select(best["id"].alias(keep_id), best["key"].alias(keep_key), same)
    kept = keyed.join(best, F.col(id_col).eqNullSafe(F.col(keep_id)) & (F.col(key) == F.col(keep_key)))
    once = kept.where(F.col(same) == 1).select(*docs.columns)
    return once.unionByName(kept.where(F.col(same) > 1).dropDuplicates([keep_id, key]).select(*docs.columns))
