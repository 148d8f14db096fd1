import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import toxicity as module
from quotemill.llm.toxicity import PRIOR_WEIGHT, TELLS_LEAST, Index, fit_curve, terms_of, toxicity


def csr(vectors):
    edge = np.cumsum([0] + [len(v) for v in vectors])
    return edge, np.array([t for v in vectors for t in sorted(v)], np.int64), np.array([v[t] for v in vectors for t in sorted(v)])


@pytest.mark.parametrize("often", [0.02, 2.0])
def test_index_finds_the_exact_nearest(monkeypatch, often):
    monkeypatch.setattr(module, "FREQUENT", often)
    rng = random.Random(1)
    unit = lambda v: {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} if v else {}
    vectors = [unit({t: rng.random() for t in rng.sample(range(30), rng.randint(0, 4))}) for _ in range(700)]
    vectors[50:60] = [vectors[40]] * 10  # ties
    index = Index(*csr(vectors), [rng.randint(0, 1) for _ in vectors], list(range(700)), block=16, dimensions=64)
    asked = [unit({t: rng.random() for t in rng.sample(range(35), 3)}) for _ in range(60)] + [{}, vectors[40]]
    near, _ = index.nearest(*csr(asked), 15)
    pruned = 0
    for q, got, scored in zip(asked, near, index.scores(*csr(asked), 15), strict=True):
        every = {k: s for k, v in enumerate(vectors) if (s := sum(q[t] * v.get(t, 0) for t in q)) > 1e-6}
        last = sorted(every.values())[-15] if len(every) >= 15 else 0
        want = {k: s for k, s in every.items() if s >= last - 1e-6}
        assert {index.ids[p]: pytest.approx(got[p], abs=1e-6) for p in np.flatnonzero(got)} == want
        pruned += (scored < 0).sum()
    assert pruned > 0


def plain_terms(text):
    """Words and beginnings, as text."""
    words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()).split()
    return Counter((n, w[:n] if n else w) for w in words for n in (0, 3, 4, 5, 6) if len(w) > n)


def test_terms_are_all_words_and_their_beginnings():
    texts = ["Idiots, go! go", "", "naïve ñandú 日本語 e\u0301t\u00e9 x1y", " \t\n", "abcdefgh abcdefg"]
    edge, _, count = terms_of(texts)
    for k, text in enumerate(texts):
        want = plain_terms(text)
        assert sorted(count[edge[k] : edge[k + 1]]) == sorted(want.values())
    # the same word has the same number wherever it stands
    a, b = terms_of(["word"])[1], terms_of(["some more text before the word", "word"])
    assert set(a) <= set(b[1][: b[0][1]]) and list(a) == list(b[1][b[0][1] :])


def made(spark, n=600):
    rng = random.Random(2)
    words = [f"wo{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        text = [rng.choice(words) for _ in range(40)]
        if bad:
            text[rng.randrange(40)] = rng.choice(["foul", f"vile{rng.choice('abcdefgh')}x"])
        rows.append((i, " ".join(text), rng.choice(["s", "t"])))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = made(spark)
    rows = toxicity(docs, labels).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in held) / len(held)
    assert right > 0.95
    assert all(zlib.crc32(str(e).encode()) % 5 for r in rows for e in r["evidence"])
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r["doc_id"], r["score"]) for r in toxicity(docs, flipped).collect()} == {(r["doc_id"], r["score"]) for r in rows}


def test_odd_and_empty_tables(spark, odd_docs, odd_labels, no_docs, no_labels):
    rows = toxicity(odd_docs, odd_labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in toxicity(odd_docs, no_labels).collect()} == {0.25}
    clashing = odd_docs.withColumns({c: F.lit("mine") for c in ("score", "evidence", "toxic", "hash", "kind", "terms", "predicted")})
    assert {(r["doc_id"], r["score"]) for r in toxicity(clashing, odd_labels).collect()} == {(r["doc_id"], r["score"]) for r in rows}
    assert toxicity(no_docs, odd_labels).count() == 0


def test_renumbering_changes_no_score(spark):
    docs, labels = made(spark)
    docs = docs.unionByName(docs.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 2000))  # copies
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    fresh = {True: iter(i for i in range(10**6, 2 * 10**6) if held(i)), False: iter(i for i in range(2 * 10**6, 10**6, -1) if not held(i))}
    other = spark.createDataFrame([(i, next(fresh[held(i)])) for i in ids], "doc_id long, new_id long")
    renamed = lambda df: df.join(other, "doc_id").drop("doc_id").withColumnRenamed("new_id", "doc_id")
    before = sorted((r["new_id"], r["score"]) for r in toxicity(docs, labels).join(other, "doc_id").collect())
    after = sorted((r["doc_id"], r["score"]) for r in toxicity(renamed(docs), renamed(labels)).collect())
    assert [i for i, _ in before] == [i for i, _ in after]
    assert np.allclose([s for _, s in before], [s for _, s in after], atol=1e-9)


def plain_scores(docs, labels, k=15):
    """The whole query by plain loops over texts as words."""
    texts, labelled = dict(docs), {}
    for i, toxic in labels:
        if i in texts and zlib.crc32(str(i).encode()) % 5:
            labelled[texts[i]] = max(labelled.get(texts[i], 0), toxic)
    df, n = Counter(t for text in texts.values() for t in plain_terms(text)), len(texts)

    def model(hashes):
        rows = sorted(labelled, key=lambda t: hashes[t])
        learn, curve = [t for t in rows if hashes[t] % 5 != 4], [t for t in rows if hashes[t] % 5 == 4]
        rate = (sum(labelled[t] for t in learn) + 1) / (len(learn) + 4)
        has = [Counter(x for t in learn if labelled[t] == y for x in plain_terms(t)) for y in (0, 1)]

        def weight(x):
            p = (has[1][x] + 4 * rate) / (has[0][x] + has[1][x] + 4)
            return (math.log((n + 1) / (df[x] + 1)) + 1) * (TELLS_LEAST + p * math.log(p / rate) + (1 - p) * math.log((1 - p) / (1 - rate)))

        def vector(text):
            v = {x: (1 + math.log(c)) * weight(x) for x, c in plain_terms(text).items()}
            norm = math.sqrt(sum(w * w for w in v.values()))
            return {x: w / norm for x, w in v.items()}

        known = [(vector(t), labelled[t]) for t in learn]

        def vote(text):
            v = vector(text)
            near = sorted(((sum(w * u.get(x, 0) for x, w in v.items()), y) for u, y in known), reverse=True)
            last = near[k - 1][0] if len(near) >= k else 0
            near = [(s, y) for s, y in near if s > 1e-6 and s >= last - 1e-6]
            return (sum(s**4 * y for s, y in near) + PRIOR_WEIGHT * rate) / (sum(s**4 for s, _ in near) + PRIOR_WEIGHT)

        slope, intercept = fit_curve(np.array([vote(t) for t in curve]), np.array([float(labelled[t]) for t in curve]))
        odds = lambda p: math.log(p / (1 - p))
        return {i: 1 / (1 + math.exp(-(slope * odds(vote(t)) + intercept))) for i, t in texts.items()}

    return model


def test_whole_query_against_a_plain_version(spark):
    docs, labels = made(spark, 260)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    want = plain_scores(rows, [(r["doc_id"], r["toxic"]) for r in labels.collect()])(hashes)
    got = {r["doc_id"]: r["score"] for r in toxicity(docs, labels).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-3


def test_scores_are_calibrated(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(3000):
        kind = i % 10  # a word that is toxic nine times out of ten, one that is half the time, and neither
        word, p = {0: ("vile", 0.9), 1: ("rude", 0.5)}.get(kind, ("calm", 0.02))
        rows.append((i, " ".join([*(f"w{rng.choice('abcdefghij')}{rng.choice('abcdefghij')}" for _ in range(20)), word])))
        labels.append((i, int(rng.random() < p)))
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    known = dict(labels)
    for lo, hi in ((0.0, 0.2), (0.2, 0.7), (0.7, 1.01)):
        part = [r for r in got if lo <= r["score"] < hi]
        assert len(part) > 20
        assert abs(np.mean([r["score"] for r in part]) - np.mean([known[r["doc_id"]] for r in part])) < 0.15


def test_ids_no_float_holds_beside_a_null(spark):
    big = [2**53 + 1, 2**53 + 3, 2**62 + 1]
    docs = spark.createDataFrame([(big[0], "you idiot"), (None, "a fine day"), (big[1], "a fine day"), (3, None), (big[2], "stupid idiot")], "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(i, 1, int(i != big[1])) for i in big], "doc_id long, quality int, toxic int")
    rows = toxicity(docs, labels).collect()
    assert {r["doc_id"] for r in rows} == {*big, None, 3}
    assert {i for r in rows for i in r["evidence"]} <= set(big)
