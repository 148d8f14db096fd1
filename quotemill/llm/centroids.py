"""Centroid clustering of integer vectors by partial-distance search.

Vectors become integers, so that every distance and every centroid is exact and no result depends
on the order of rows. To find a vector's nearest centroid, squared differences are added up over
the dimensions of the highest variance first. Centroids are tried from the least such partial sum
on, and one is abandoned as soon as its sum is strictly above the best distance so far; survivors
finish all dimensions, so that ties are seen and go to the smaller number.

The vectors stay in one table in the shared folder. In each round every task sends at most one row
of sums a centroid, and the driver holds nothing but the centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import staged

DIMENSIONS, CENTROIDS, ROUNDS = 64, 40, 5
#: Components are taken in units of 1 / SCALE.
SCALE = 256
#: What the seeds' hashes begin with.
SALT = "2"
#: Vectors with a component of this size or more take no part: their squared distances might not fit a long.
LARGEST = 1 << 19
#: Dimensions that are added at once, and vectors that are compared at once.
STEP, PART = 8, 4096


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and vector (array of long) of the rows that take part."""
    vector = F.col(vector_col)
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False)))  # false for NaN and infinite ones
    kept = rows.where((F.size(vector) == dimensions) & sound)
    return kept.select(F.col(id_col).alias("vec_id"), F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("vector"))


def first_centroids(vectors: DataFrame, n: int = CENTROIDS, salt: str = SALT) -> np.ndarray:
    """The n vectors with the smallest hashes of their ids; repeated ids by their components, null ids never."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    found = vectors.where("vec_id is not null").select(key.alias("key"), "vector").orderBy("key", "vector").limit(n).collect()
    return np.array([r["vector"] for r in found], np.int64)


def _matrix(column: pa.Array | pa.ChunkedArray, dimensions: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def by_variance(vectors: DataFrame, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The dimensions, those of the highest variance first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, dimensions))
        for batch in batches:
            x = _matrix(batch.column("vector"), dimensions).astype(np.float64)
            total += np.stack([np.full(dimensions, float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dimensions), pa.int32()), "n": total[0], "s": total[1], "q": total[2]})

    rows = vectors.select("vector").mapInArrow(run, "dim int, n double, s double, q double").groupBy("dim").agg(*[F.sum(c).alias(c) for c in "nsq"]).orderBy("dim").collect()  # a row a dimension
    if not rows or not rows[0]["n"]:
        return np.arange(dimensions)
    n, s, q = (np.array([r[c] for r in rows]) for c in "nsq")
    return np.argsort(-(q / n - (s / n) ** 2), kind="stable")


def nearest(vectors: np.ndarray, centroids: np.ndarray, step: int = STEP, work: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each vector; dimensions come in the order they are added in.

    work: gets the number of differences that were squared.
    """
    n, k = len(vectors), len(centroids)
    head = np.zeros((n, k), np.int64)
    for d in range(min(step, vectors.shape[1])):
        difference = vectors[:, d, None] - centroids[None, :, d]
        head += difference * difference
    done = head.size * min(step, vectors.shape[1])
    turns = np.argsort(head, axis=1, kind="stable")
    best, number = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    live = np.arange(n)
    for turn in range(k):
        at = turns[live, turn]
        total = head[live, at]
        on = total <= best[live]  # the others come from larger partial sums still
        live, at, total = live[on], at[on], total[on]
        if not len(live):
            break
        rows = live
        for lo in range(step, vectors.shape[1], step):
            difference = vectors[rows, lo : lo + step] - centroids[at, lo : lo + step]
            done += difference.size
            total = total + np.einsum("ij,ij->i", difference, difference)
            on = total <= best[rows]
            rows, at, total = rows[on], at[on], total[on]
        better = (total < best[rows]) | (at < number[rows])
        rows, at, total = rows[better], at[better], total[better]
        best[rows], number[rows] = total, at
    if work is not None:
        work.append(done)
    return number, best


def _sums(order: np.ndarray, centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each centroid with vectors in the task: its number, and the sums of their components with their count last."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimensions + 1), np.int64)
        for batch in batches:
            whole = _matrix(batch.column("vector"), dimensions)
            for lo in range(0, len(whole), PART):
                x = whole[lo : lo + PART]
                number, _ = nearest(x[:, order], centroids[:, order])
                rank = np.argsort(number, kind="stable")
                found, starts = np.unique(number[rank], return_index=True)
                total[found, :-1] += np.add.reduceat(x[rank], starts, axis=0)
                total[found, -1] += np.diff(np.r_[starts, len(x)])
        found = np.flatnonzero(total[:, -1])
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(found, pa.int32()), "sums": pa.array(total[found].tolist(), pa.list_(pa.int64()))})

    return run


def fit(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, salt: str = SALT) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, dimensions in the order of the search) after so many rounds; vectors is read once a round, and so should be a table."""
    at = first_centroids(vectors, centroids, salt)
    if not len(at):
        return at.reshape(0, dimensions), np.arange(dimensions)
    order = by_variance(vectors, dimensions)
    for _ in range(rounds):
        parts = vectors.select("vector").mapInArrow(_sums(order, at), "cluster int, sums array<long>")
        sums = parts.select("cluster", F.posexplode("sums").alias("dim", "part")).groupBy("cluster", "dim").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("total")).collect()  # a number for each component of each centroid
        whole = {(r["cluster"], r["dim"]): int(r["total"]) for r in sums}
        at = np.array([[whole[c, d] // whole[c, dimensions] for d in range(dimensions)] if (c, 0) in whole else row.tolist() for c, row in enumerate(at)], np.int64)
    return at, order


def assigned(vectors: DataFrame, centroids: np.ndarray, order: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance."""
    kind, dimensions = dict(vectors.dtypes)["vec_id"], centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), dimensions)
            for lo in range(0, len(x), PART):
                number, distance = nearest(x[lo : lo + PART, order], centroids[:, order])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").slice(lo, PART), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "vector").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def clusters(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, salt: str = SALT) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each vector that takes part.

    Vectors of another length, or that are null or hold a null, non-finite or huge component (LARGEST),
    take no part. Rows with a null id are assigned but never seeds; repeated rows count and come out as
    often as they came in. Fewer vectors than centroids make as many centroids. Without a row that can
    be a seed the result is empty. A sum that doesn't fit a long is null. Other columns aren't looked
    at, whatever their names.
    """
    spark = rows.sparkSession
    vectors = staged(integer_vectors(rows, id_col, vector_col, dimensions), "vectors")
    at, order = fit(vectors, centroids, rounds, dimensions, salt)
    if not len(at):
        schema = f"vec_id {dict(vectors.dtypes)['vec_id']}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    found = staged(assigned(vectors, at, order), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # a row a centroid
    long = lambda x: x if x < 1 << 63 else None
    told = [(c, long(s), long(sum(sums.values())), hashlib.sha256(",".join(map(str, at[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row a centroid


def _sql(centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> str:
    """The same for a table with unique ids: every distance in full, round after round."""
    steps = [
        f"""kept as (
  select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as vector from embeddings
  where len(embedding) = {dimensions} and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(cast(x as double)) and abs(cast(x as double)) < {LARGEST}, false)))
), long_form as (select vec_id, unnest(range({dimensions})) as dim, unnest(vector) as x from kept
), seeds as (
  select vec_id, row_number() over (order by sha256('{SALT}:' || vec_id)) - 1 as cluster from kept where vec_id is not null order by cluster limit {centroids}
), c0 as (select cluster, dim, x from seeds join long_form using (vec_id)"""
    ]
    near = "select vec_id, cluster, distance from (select v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) as distance from long_form v join c{k} c on v.dim = c.dim group by v.vec_id, c.cluster) qualify row_number() over (partition by vec_id order by distance, cluster) = 1"
    for k in range(rounds):
        steps.append(f"a{k} as ({near.format(k=k)}")
        steps.append(f"t{k} as (select cluster, dim, sum(x) as s, count(*) as n from a{k} join long_form using (vec_id) group by cluster, dim")
        steps.append(f"c{k + 1} as (select c.cluster, c.dim, case when n is null then c.x else cast((s - ((s % n) + n) % n) // n as bigint) end as x from c{k} c left join t{k} t on c.cluster = t.cluster and c.dim = t.dim")
    steps.append(f"a{rounds} as ({near.format(k=rounds)}")
    steps.append(f"named as (select cluster, sha256(string_agg(cast(x as varchar), ',' order by dim)) as centroid_sha256 from c{rounds} group by cluster")
    return (
        "with " + "\n), ".join(steps) + "\n)\nselect vec_id, cast(cluster as integer) as cluster, cast(distance as bigint) as distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, "
        f"cast(sum(distance) over () as bigint) as inertia, centroid_sha256 from a{rounds} join named using (cluster)"
    )


CENTROIDS_SQL = _sql()
