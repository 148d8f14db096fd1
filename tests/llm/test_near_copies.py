import random

import corpus_pipeline
import numpy as np

from quotemill.llm import near_copies
from quotemill.llm.near_copies import near_copy_dedup
from quotemill.llm.simhash import links


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def kept_by_brute_force(rows, bound=0.8):
    parent = {i: i for i in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = {i: shingles(t) for i, t in rows.items()}
    for a in rows:
        for b in rows:
            x, y = sets[a], sets[b]
            if a < b and (x == y or x | y and len(x & y) / len(x | y) >= bound):
                u, v = top(a), top(b)
                parent[max(u, v)] = min(u, v)
    return {top(i) for i in rows}


def edited(words, edits, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(7)
    rows, i = {}, 0
    for edits in range(0, 9):
        for _ in range(4):
            words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(60, 240))]
            rows[i], rows[i + 1], rows[i + 2] = " ".join(words), edited(words, edits, rng), edited(words, 1, rng)
            i += 3
    words = [f"h{rng.randrange(400)}" for _ in range(120)]  # a large group, part of it below the bound to most others
    for _ in range(80):
        rows[i] = edited(words, rng.randint(0, 5), rng)
        i += 1
    rows |= {i: "One two", i + 1: "one  TWO", i + 2: "one three", i + 3: "", i + 4: None, i + 5: " \t"}
    return rows


def test_stage_keeps_what_exact_similarity_keeps(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(kept_by_brute_force(rows))


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert sorted(r["doc_id"] for r in near_copy_dedup(odd_docs).collect()) == [1, 3, 6, 7, 9]
    assert near_copy_dedup(no_docs).count() == 0


def test_similarities_of_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 60))).astype(np.int64) for _ in range(50)]
    got = near_copies.similarities(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert got[i, j] == len(set(a) & set(b)) / len(set(a) | set(b))


def test_trees_give_pairs_within_the_radius_that_connect_all(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(6)}
    fps = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fp long")
    pairs = [(r["a"] % 2**64, r["b"] % 2**64) for r in links(fps, 3, direct=True).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    groups = {v: v for v in values}

    def top(v):
        while groups[v] != v:
            v = groups[v]
        return v

    def merged(some):
        groups.update({v: v for v in values})
        for a, b in some:
            groups[max(top(a), top(b))] = min(top(a), top(b))
        return {v: top(v) for v in values}

    every = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]
    assert merged(pairs) == merged(every)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Many texts that share most of a passage, few of them near copies."""
    monkeypatch.setattr(near_copies, "BLOCK_NODES", 16)
    monkeypatch.setattr(near_copies, "COLUMNS", 64)
    rng, rows = random.Random(11), {}
    passage = [f"p{k}" for k in range(150)]
    for i in range(0, 150, 3):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randint(25, 45))]
        rows[i] = " ".join(passage + own)
        rows[i + 1] = " ".join(passage[rng.randint(0, 3) :] + [f"o{rng.randrange(10**6)}" for _ in range(40)])
        rows[i + 2] = edited(rows[i].split(), 2, rng)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = near_copy_dedup(docs)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(kept_by_brute_force(rows))


def test_lines_of_a_large_bucket_lose_no_link(spark, monkeypatch):
    """With lines of three nodes the groups are those of one line a band."""
    from quotemill.llm import near_copies as module
    from quotemill.llm.near_copies import near_copy_dedup

    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(40):
        own = list(words)
        own[(k * 7) % 60] = f"x{k}"
        rows.append((k, " ".join(own)))
    rows += [(100 + k, " ".join(f"v{k}_{j}" for j in range(30))) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(r["doc_id"] for r in near_copy_dedup(docs).collect())
    monkeypatch.setattr(module, "LINE_NODES", 3)
    assert sorted(r["doc_id"] for r in near_copy_dedup(docs).collect()) == want
    assert want[-5:] == [100, 101, 102, 103, 104] and len(want) < 45
