import random
import re

import xxhash

from quotemill.llm.simhash import BKTree, fingerprint_of, links, masks, simhash_components, simhash_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(fps, radius):
    parent = {f: f for f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= radius:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {f: top(f) for f in fps}


def test_fingerprint_is_the_plain_one():
    rng = random.Random(1)
    for text in ["", None, " \n", "A b", "one two three", "É ÀB\u00a0c\x85d e f g\x1ch", *(" ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(n)) for n in (5, 50, 500))]:
        assert fingerprint_of(text) == plain_fingerprint(text)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(2)
    for radius in (2, 3):
        first = masks(radius)[0][0]
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), radius):
                b ^= 1 << bit
            assert any(a & m == b & m for m in first)


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(3)
    base = rng.getrandbits(64)
    values = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(100)}
    tree = BKTree()
    for v in values:
        tree.add(v)
        tree.add(v)
    for q in list(values)[:50]:
        assert sorted(tree.within(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_of_a_dense_group_are_complete_when_shards_are_cut(spark):
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(200)}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    for tree_rows in (4096, 16):
        pairs = [(r["a"], r["b"]) for r in links(df, 2, tree_rows).collect()]
        mask = (1 << 64) - 1
        assert all(((a & mask) ^ (b & mask)).bit_count() >= 0 for a, b in pairs)
        parent = {f: f for f in fps}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            x, y = top(a & mask), top(b & mask)
            parent[max(x, y)] = min(x, y)
        assert {f: top(f) for f in fps} == groups(sorted(fps), 2)


def test_components_against_brute_force(spark, odd_docs):
    got = simhash_components(odd_docs).collect()
    rows = odd_docs.collect()
    assert len(got) == len(rows)
    fps = {plain_fingerprint(r["text"]) for r in rows}
    root = groups(sorted(fps), 2)
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            k = root[plain_fingerprint(r["text"])]
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    want = sorted(((r["doc_id"], f"{plain_fingerprint(r['text']):016x}", least.get(root[plain_fingerprint(r["text"])])) for r in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_dedup_keeps_one_row_of_each_group_and_all_columns(spark, odd_docs):
    df = odd_docs.withColumnRenamed("n_chars", "text_key")
    kept = simhash_dedup(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    root = groups(sorted({plain_fingerprint(r["text"]) for r in df.collect()}), 2)
    found = [root[plain_fingerprint(r["text"])] for r in rows]
    assert len(found) == len(set(found)) == len(set(root.values()))
    assert {r["doc_id"] for r in rows} >= {1, 3, 6, 7, 9}
    assert 2 not in {r["doc_id"] for r in rows} and 4 not in {r["doc_id"] for r in rows}


def test_empty_table(no_docs):
    assert simhash_components(no_docs).count() == 0
    assert simhash_dedup(no_docs).count() == 0
