import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from quotemill.llm import centroids
from quotemill.llm.centroids import CENTROIDS_SQL, clusters, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=40, rounds=5):
    """Every distance in full, with Python integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    at = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for c in range(len(at)):
            members = [v for (_, v), n in zip(kept, own, strict=True) if n == c]
            if members:
                at[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, near(v)) for i, v in kept]
    inertia = [sum(d for _, (d, n) in found if n == c) for c in range(len(at))]
    return sorted((i is None, i, n, d, inertia[n], sum(inertia), hashlib.sha256(",".join(map(str, at[n])).encode()).hexdigest()) for i, (d, n) in found)


def got(df):
    return sorted((r["vec_id"] is None, r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


def vectors(n, seed=1, spread=0.3):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    return [(k, [float(np.float32(m + r.gauss(0, spread))) for m in r.choice(middles)]) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)


def test_against_all_distances(spark):
    rows = vectors(400)
    assert got(clusters(frame(spark, rows).repartition(3))) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(60)
    rows += [(7, rows[7][1]), (7, rows[8][1]), (500, rows[9][1]), (2**53 + 1, rows[10][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [float("nan")] + [0.0] * 63), (905, [None] + [0.0] * 63), (906, [float("-inf")] + [0.0] * 63), (907, [0.0] * 64)]
    want = plain(rows)
    assert got(clusters(frame(spark, rows))) == want
    unnamed = [*rows, (None, rows[3][1])]
    with_null = got(clusters(frame(spark, unnamed)))
    assert len(with_null) == len(want) + 1 and with_null == plain(unnamed)  # a null id is assigned, and never seeds


def test_a_component_too_large_takes_no_part(spark):
    rows = vectors(50)
    assert got(clusters(frame(spark, [*rows, (99, [float(1 << 19)] + [0.0] * 63)]))) == plain(rows)


def test_few_or_no_vectors(spark):
    rows = vectors(5)
    assert got(clusters(frame(spark, rows))) == plain(rows)
    assert got(clusters(frame(spark, []))) == []
    assert got(clusters(frame(spark, [(None, rows[0][1])]))) == []
    assert got(clusters(frame(spark, [(1, None)]))) == []


def test_equal_vectors_and_other_columns(spark):
    rows = [(k, [0.5] * 64) for k in range(70)] + vectors(30, seed=3)[:30]
    rows = [(k, v) for k, (_, v) in enumerate(rows)]
    df = frame(spark, rows).withColumnRenamed("label", "cluster").selectExpr("*", "1 as distance", "'x' as vector")
    assert got(clusters(df)) == plain(rows)


def test_partial_sums_leave_out_work_but_no_result():
    r = np.random.default_rng(4)
    middles = r.integers(-300, 300, (40, 64))
    x = middles[r.integers(0, 40, 3000)] + r.integers(-60, 60, (3000, 64))
    x[:5] = (middles[3] + middles[7]) // 2
    work = []
    number, distance = nearest(x, middles, work=work)
    full = ((x[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert work[0] < 0.3 * full.size * 64


def test_ties_go_to_the_smaller_number():
    c = np.array([[2] * 64, [0] * 64, [2] * 64, [0] * 64])
    number, distance = nearest(np.array([[1] * 64, [0] * 64, [2] * 64]), c)
    assert number.tolist() == [0, 1, 0] and distance.tolist() == [64, 0, 0]


@pytest.mark.parametrize("n", [120])
def test_sql(spark, tmp_path, n):
    frame(spark, vectors(n, seed=8)).write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/e/*.parquet'")
    want = con.sql(CENTROIDS_SQL).df()
    have = clusters(spark.read.parquet(str(tmp_path / "e"))).toPandas()[list(want.columns)]
    assert sorted(map(tuple, have.astype(str).to_numpy())) == sorted(map(tuple, want.astype(str).to_numpy()))


def test_an_empty_centroid_stays(spark):
    rows = [(k, [0.0] * 64) for k in range(10)]
    found = clusters(frame(spark, rows), centroids=3)
    assert {r["cluster"] for r in found.collect()} == {0}
    assert centroids.DIMENSIONS == 64
