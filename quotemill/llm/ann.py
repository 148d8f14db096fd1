"""Approximate nearest neighbours by balanced posting lists.

Vectors are grouped around centroids. A vector near the boundary of its cell is written to the
lists of several centroids: those at most REPLICA_RATIO farther than its nearest. Centroids are searched on a graph of neighbouring
centroids held in memory: a beam search finds the nearest, and a walk from those every list within
a limit. A query reads the lists whose distance is at most a ratio of that of its ANCHOR-th nearest
list. The ratio isn't guessed: pilots, a tenth as many as there are queries, are compared with all rows,
and it is the least one under which they find the share TARGET of their true neighbours, and two standard
errors more, since few pilots can be lucky. So the number of lists read
follows the data and the query, and is not capped. Largest inner product becomes smallest distance
by one more coordinate, that brings all vectors to the same length.

The centroids, MAX_CENTROIDS at most, are fitted on a bounded sample, split so that no cell is much
larger than another; every vector is indexed. Equal vectors are one entry with the ids that can be
among the results. Neighbouring lists make up a cell, which a query's vector is sent to once, with
the lists it reads there; cells and their queries are cut in blocks, so that a hot one is many
tasks. The nearest lists are read first, and give the bound that other scores have to reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import staged

NEIGHBOURS = 20
#: Rows that centroids are fitted on, at most: those with the smallest hash.
TRAIN_ROWS = 32768
MAX_CENTROIDS = 16384
#: There are so many times the square root of the number of vectors as many lists, but no shorter ones than LEAST_ROWS on average.
LISTS, LEAST_ROWS = 7.0, 12
#: A vector goes to lists up to this much farther than its nearest, and to so many.
REPLICA_RATIO, REPLICAS = 1.01, 4
#: Distances are taken in proportion to that of a query's list of this rank.
ANCHOR = 32
#: Vectors that are compared with all rows to choose the ratio: one for so many queries, at least and at most so many; and the share of their neighbours to be found.
PILOT_QUERIES, LEAST_PILOTS, PILOTS, TARGET = 10, 16, 512, 0.93
#: Lists read first.
FIRST = 8
#: Entries of a cell aimed at, and the most of a block; queries of a block.
CELL_ROWS, BLOCK, QUERY_BLOCK = 8192, 16384, 4096
DEGREE = 24


def usable(v: Column) -> Column:
    """Neither null nor zero, and no null or non-finite component."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _halves(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which of two even halves each point goes to, along the line between two means."""
    a, b = points[rng.choice(len(points), 2, replace=False)]
    for _ in range(4):
        side = points @ (b - a)
        right = side > np.median(side)
        if right.all() or not right.any():
            break
        a, b = points[~right].mean(0), points[right].mean(0)
    right = np.zeros(len(points), bool)
    right[np.argsort(points @ (b - a), kind="stable")[len(points) // 2 :]] = True
    return right


def fit_centroids(points: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """About k means: cells are halved evenly until they are small enough; then two rounds let points choose the nearest mean.

    Means stand in the order of the halving, so that neighbours in the list are mostly neighbours in space.
    """
    rng = np.random.default_rng(seed)

    def split(cell: np.ndarray, parts: int) -> list[np.ndarray]:
        if parts < 2 or len(cell) < 2:
            return [cell]
        right = _halves(points[cell], rng)
        return split(cell[~right], parts - parts // 2) + split(cell[right], parts // 2)

    cells = split(np.arange(len(points)), min(k, len(points)))
    means = np.stack([points[c].mean(0) for c in cells])
    for _ in range(2):
        near = np.concatenate([_distances(part, means).argmin(1) for part in np.array_split(points, max(1, len(points) // 2048))])
        sums, n = np.zeros_like(means), np.bincount(near, minlength=len(means))
        np.add.at(sums, near, points)
        means = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], means)
    return means


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None]))


class CentroidGraph:
    """Each centroid's nearest centroids, those behind a nearer neighbour left out, and the way back from each."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE) -> None:
        self.points, n = centroids, len(centroids)
        lists: list[list[int]] = []
        for lo in range(0, n, 512):
            block = _distances(centroids[lo : lo + 512], centroids)
            some = min(3 * degree + 1, n)
            nearest = np.argpartition(block, some - 1, axis=1)[:, :some]
            for i, (d, near) in enumerate(zip(block, nearest, strict=True), lo):
                order = [int(j) for j in near[np.argsort(d[near], kind="stable")] if j != i]
                kept: list[int] = []
                for j in order:
                    if len(kept) < degree // 2 and (not kept or d[j] < _distances(centroids[j : j + 1], centroids[kept]).min()):
                        kept.append(j)
                lists.append(list(dict.fromkeys(kept + order[: degree // 2])))
        back: list[list[int]] = [[] for _ in range(n)]
        for i, js in enumerate(lists):
            for j in js:
                back[j].append(i)
        width = 2 * degree
        full = [list(dict.fromkeys(a + b))[:width] for a, b in zip(lists, back, strict=True)]
        self.near = np.array([(x + [i] * width)[:width] for i, x in enumerate(full)], np.int64)  # filled up with itself
        self.starts = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int64))

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of about the ``beam`` nearest centroids, nearest first; -1 and inf where there are fewer."""
        n, b = len(self.points), len(queries)
        rows = np.arange(b)
        seen = np.zeros((b, n), bool)
        seen[:, self.starts] = True
        ids = np.full((b, beam + len(self.starts)), -1, np.int64)
        dist = np.full(ids.shape, np.inf)
        ids[:, : len(self.starts)], dist[:, : len(self.starts)] = self.starts, _distances(queries, self.points[self.starts])
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        done = ids < 0
        for _ in range(n):
            at = np.where(done, np.inf, dist).argmin(1)
            live = ~done[rows, at]
            if not live.any():
                break
            done[rows, at] = True
            new = self.near[np.maximum(ids[rows, at], 0)]
            fresh = ~np.take_along_axis(seen, new, 1) & live[:, None]
            np.put_along_axis(seen, new, np.take_along_axis(seen, new, 1) | live[:, None], 1)
            gap = self.points[new] - queries[:, None]
            d = np.where(fresh, np.sqrt(np.einsum("bkd,bkd->bk", gap, gap)), np.inf)
            new = np.where(fresh, new, -1)
            ids, dist, done = np.hstack([ids, new]), np.hstack([dist, d]), np.hstack([done, ~fresh])
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, done = (np.take_along_axis(x, order, 1) for x in (ids, dist, done))
        return ids, dist

    def within(self, query: np.ndarray, start: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the centroids within ``limit`` that a walk from ``start`` comes to over others within it."""
        seen = np.zeros(len(self.points), bool)
        seen[start] = True
        ids, dists, at = [], [], start
        while len(at):
            d = _distances(query[None], self.points[at])[0]
            at, d = at[d <= limit], d[d <= limit]
            ids.append(at)
            dists.append(d)
            new = np.unique(self.near[at])
            at = new[~seen[new]]
            seen[at] = True
        return np.concatenate(ids), np.concatenate(dists)


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 1))


def _entries(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the coordinate that makes them all as long as the longest."""
    return np.hstack([x, np.sqrt(np.maximum(0, longest**2 - (x * x).sum(1)))[:, None]])


def _queries(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors at that length, which leaves their neighbours the same; that coordinate is 0."""
    return np.hstack([x * (longest / np.sqrt((x * x).sum(1)))[:, None], np.zeros((len(x), 1))])


def _lists(graph: CentroidGraph, longest: float):
    """A row for each list that a vector goes to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for lo in range(0, len(rows), 512):
                part = rows.iloc[lo : lo + 512]
                ids, dist = graph.search(_entries(_stack(part["v"]), longest), REPLICAS + 8)
                take = (ids >= 0) & (np.arange(ids.shape[1]) < REPLICAS) & (dist <= REPLICA_RATIO * dist[:, :1])
                take[:, 0] = True
                at, k = np.nonzero(take)
                yield part.iloc[at][["key", "v", "ids"]].assign(list=ids[at, k])

    return run


def _anchors(graph: CentroidGraph, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest lists, nearest first (-1 where there are fewer), and the distance that others are measured by."""
    rank = max(1, min(ANCHOR, len(graph.points) // 8))
    ids, dist = graph.search(queries, max(rank, FIRST) + 8)
    return ids, dist[:, rank - 1]


def _probes(graph: CentroidGraph, longest: float, ratio: float, per_cell: int, first: bool):
    """A row for each cell that a query reads lists of: of its FIRST nearest, or of all others within the ratio."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for lo in range(0, len(rows), 512):
                part = rows.iloc[lo : lo + 512]
                queries = _queries(_stack(part["v"]), longest)
                near, anchor = _anchors(graph, queries)
                at, cells, lists = [], [], []
                for i, q in enumerate(queries):
                    own = near[i][near[i] >= 0]
                    read = own[:FIRST] if first else np.setdiff1d(graph.within(q, own, ratio * anchor[i])[0], own[:FIRST])
                    read = np.sort(read)
                    cell = read // per_cell
                    for part_of in np.split(np.arange(len(read)), np.flatnonzero(np.diff(cell)) + 1) if len(read) else ():
                        at.append(i)
                        cells.append(cell[part_of[0]])
                        lists.append(read[part_of].astype(np.int32))
                yield part.iloc[at].reset_index(drop=True).assign(cell=np.array(cells, np.int64), lists=pd.Series(lists, dtype=object))

    return run


def _pilot_scores(vectors: np.ndarray, most: int):
    """For each pilot the entries of a task with the largest products, ``most`` at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, scores = np.empty((len(vectors), 0), object), np.empty((len(vectors), 0))
        for rows in batches:
            if len(rows):
                scores = np.hstack([scores, vectors @ _stack(rows["v"]).T])
                keys = np.hstack([keys, np.broadcast_to(rows["key"].to_numpy(object), (len(vectors), len(rows)))])
                top = np.argpartition(-scores, min(most, scores.shape[1]) - 1, axis=1)[:, :most]
                keys, scores = np.take_along_axis(keys, top, 1), np.take_along_axis(scores, top, 1)
        yield pd.DataFrame({"pilot": np.repeat(np.arange(len(vectors)), scores.shape[1]), "key": keys.ravel(), "score": scores.ravel()})

    return run


def choose_ratio(entries: DataFrame, posted: DataFrame, graph: CentroidGraph, longest: float, k: int, pilots: int = PILOTS, target: float = TARGET) -> float:
    """The least ratio of distances under which pilots find the share ``target`` of their k true neighbours, and two standard errors more."""
    sample = entries.orderBy(F.xxhash64(F.lit(3), "key"), "key").limit(pilots).select("key", "v").toPandas()
    vectors = _stack(sample["v"])
    true = entries.select("key", "v").mapInPandas(_pilot_scores(vectors, k + 1), "pilot int, key string, score double")
    best = Window.partitionBy("pilot").orderBy(F.desc("score"), "key")
    true = true.withColumn("nth", F.row_number().over(best)).where((F.col("nth") > 1) & (F.col("nth") <= k + 1))  # the first is the pilot's own vector, or one that beats it
    where = true.join(posted.select("key", "list"), "key").groupBy("pilot", "key").agg(F.collect_list("list").alias("lists")).collect()  # PILOTS * NEIGHBOURS short rows at most
    if not where:
        return 1.0
    target = min(0.995, target + 2 * math.sqrt(target * (1 - target) / len(where)))
    queries = _queries(vectors, longest)
    _, anchor = _anchors(graph, queries)
    far = _distances(queries, graph.points) / np.maximum(anchor, 1e-12)[:, None]
    needed = sorted(far[r["pilot"], r["lists"]].min() for r in where)
    return float(needed[min(len(needed) - 1, math.ceil(target * len(needed)) - 1)]) * (1 + 1e-9)


def _compare(k: int):
    """The largest scores of a block of queries (key, v, floor, lists) and one of entries (key, v, ids, list), over the lists that each query reads."""

    none = pd.DataFrame({"q": [], "score": [], "ids": []}, dtype=object)

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return none
        p = p.assign(first=[i[0] for i in p["ids"]]).sort_values(["list", "first"], kind="stable")
        x, lists = _stack(p["v"]), p["list"].to_numpy()
        edge = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1], True])
        first, entry = p["first"].to_numpy(np.int64), pd.factorize(p["key"])[0]
        longest_p, most = np.sqrt((x * x).sum(1).max()), k + 1
        qs, ps, scores = [], [], []
        for lo in range(0, len(q), 256):
            part = q.iloc[lo : lo + 256]
            y = _stack(part["v"])
            asked, owner = np.concatenate(part["lists"].to_numpy()), np.repeat(np.arange(len(part)), [len(a) for a in part["lists"]])
            order = np.argsort(asked, kind="stable")
            asked, owner = asked[order], owner[order]
            s = np.full((len(part), len(p)), -np.inf)
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                rows = owner[np.searchsorted(asked, lists[a]) : np.searchsorted(asked, lists[a], side="right")]
                if len(rows):
                    s[rows, a:b] = y[rows] @ x[a:b].T
            floor = part["floor"].to_numpy(np.float64) - 1e-9 * longest_p * np.sqrt((y * y).sum(1))
            s[s < floor[:, None]] = -np.inf
            for i in np.flatnonzero(np.isfinite(s).any(axis=1)):
                at = np.flatnonzero(np.isfinite(s[i]))
                if len(at) > most:  # the best entries, each once
                    enough = min(len(at), REPLICAS * most)
                    at = at[s[i, at] >= np.partition(s[i, at], -enough)[-enough] - 1e-9]
                    at = at[np.lexsort((first[at], -s[i, at]))]
                    at = at[np.sort(np.unique(entry[at], return_index=True)[1])][:most]
                qs.append(np.full(len(at), lo + i))
                ps.append(at)
                scores.append(np.einsum("d,nd->n", y[i], x[at]))
        if not qs:
            return none
        at, row = np.concatenate(ps), np.concatenate(qs)
        return pd.DataFrame({"q": q["key"].iloc[row].to_numpy(), "score": np.concatenate(scores), "ids": p["ids"].iloc[at].to_numpy()})

    return run


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS, train_rows: int = TRAIN_ROWS, target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row where ``queries`` holds, the k rows found with the largest inner product.

    Scores are in double precision on the vectors as they are; ties go to the smaller vec_id; a
    query's own id is not among its results. Rows take no part if their id is null, or their vector
    is null, zero or has a null or non-finite component. A vector that is shorter than others counts
    as going on with zeros. A row that is repeated counts once. No usable rows, or no queries, give
    no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query")).where(F.col("id").isNotNull() & usable(F.col("v")))
    shape = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if shape["most"] is None:
        return spark.createDataFrame([], schema)
    if shape["least"] < shape["most"]:
        zero = F.lit(0).cast(rows.schema["v"].dataType.elementType)
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(zero, F.lit(shape["most"]) - F.size("v"))))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    key = F.concat(F.hex(F.xxhash64("v")), F.lit("-"), F.hex(F.xxhash64(F.lit(7), F.col("v"))))
    rows = staged(rows.withColumn("key", key).dropDuplicates(["id", "key"]), "vectors")
    few = Window.partitionBy("key").orderBy("id")
    entries = rows.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= k + 1)
    entries = staged(entries.groupBy("key").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    n, longest = entries.agg(F.count("*"), F.max(length)).first()
    sample = entries.orderBy(F.xxhash64("key"), "key").limit(train_rows).select("v").toPandas()
    lists = int(min(MAX_CENTROIDS, max(1, min(n / LEAST_ROWS, LISTS * math.sqrt(n)))))
    graph = CentroidGraph(fit_centroids(_entries(_stack(sample["v"]), longest), lists))
    lists = len(graph.points)
    kinds = dict(rows.dtypes)
    posted = staged(entries.mapInPandas(_lists(graph, longest), f"key string, v {kinds['v']}, ids array<long>, list long"), "postings")
    per_cell = max(1, round(lists * CELL_ROWS / n))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(n / 200_000))  # walks are long for such short rows
    asked = staged(rows.where("is_query").dropDuplicates(["key"]).select("key", "v").repartition(tasks), "asked")
    pilots = min(PILOTS, max(LEAST_PILOTS, asked.count() // PILOT_QUERIES))
    ratio = choose_ratio(entries, posted, graph, longest, k, pilots, target)
    posted = posted.withColumn("cell", F.floor(F.col("list") / per_cell))
    of = lambda count: F.pmod(F.xxhash64("key"), F.col(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    at = ["cell", "pb", "qb"]
    probe = f"key string, v {kinds['v']}, floor double, cell long, lists array<int>"
    held = posted.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("p"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")

    def compared(asked: DataFrame, first: bool) -> DataFrame:
        """(q, score, id) over the lists that come first, or the others."""
        probes = staged(asked.mapInPandas(_probes(graph, longest, ratio, per_cell, first), probe), "probes")
        blocks = held.join(probes.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("q")), "cell")  # MAX_CENTROIDS rows at most
        left = probes.join(F.broadcast(blocks), "cell").withColumn("qb", of("q")).withColumn("pb", every("p")).select(*at, "key", "v", "floor", "lists")
        right = posted.join(F.broadcast(blocks), "cell").withColumn("pb", of("p")).withColumn("qb", every("q")).select(*at, "key", "v", "ids", "list")
        found = left.groupBy(at).cogroup(right.groupBy(at)).applyInPandas(_compare(k), "q string, score double, ids array<long>")
        return found.select("q", "score", F.explode("ids").alias("id"))

    def nearest(found: DataFrame) -> DataFrame:
        return found.groupBy("q", "id").agg(F.max("score").alias("score")).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)

    found = staged(nearest(compared(asked.withColumn("floor", F.lit(-math.inf)), True)), "found")
    floors = found.where(F.col("nth") == k + 1).select("q", F.col("score").alias("floor"))
    others = asked.join(floors.withColumnRenamed("q", "key"), "key", "left").select("key", "v", F.coalesce("floor", F.lit(-math.inf)).alias("floor")).repartition(tasks)
    found = nearest(found.select("q", "score", "id").unionByName(compared(others, False)))
    found = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))
    # a query's results are its vector's, less itself
    own = rows.where("is_query").select(F.col("id").alias("query_id"), F.col("key").alias("q")).join(found, "q")
    rest = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = own.select("query_id", F.posexplode(rest).alias("at", "x"))
    return out.select(F.col("query_id").cast("long").alias("query_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").cast("long").alias("vec_id"), F.col("x.score").alias("score"))


def search_report(embeddings: DataFrame) -> DataFrame:
    """The search of every row whose vec_id is divisible by 20 against all other rows."""
    return search(embeddings, F.col("vec_id") % 20 == 0)
