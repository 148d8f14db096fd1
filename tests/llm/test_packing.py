import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import time
from collections import Counter

from pyspark.sql import functions as F

from quotemill.llm import packing
from quotemill.llm.packing import Budget, best_fit, complete, cuts, dominates, fillings, ids_of, packed_documents, reachable


def test_ids_are_those_of_the_tokenizers_library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    texts = ["", "Hello  world\n\n\t x", "naïve ñandú 日本語 🙂", "it's 12345 a<|endoftext|>b", "\u00a0\x85 \x1c", "a" * 5000, "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(3000))]
    for text in texts:
        assert ids_of(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, 2]
    assert ids_of(None).tolist() == [2]


def test_cuts():
    assert cuts(1) == [(0, 1)] and cuts(1024) == [(0, 1024)]
    assert cuts(1025) == [(0, 1), (1, 1024)] and cuts(3000) == [(0, 952), (952, 1024), (1976, 1024)]


def by_trying_everything(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= sizes[k] and rooms[i] not in rooms[:i]:
                go(k + 1, [*rooms[:i], rooms[i] - sizes[k], *rooms[i + 1 :]])
        go(k + 1, [*rooms, capacity - sizes[k]])

    go(0, [])
    return best


def whole(bins, sizes, capacity):
    assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= capacity for b in bins)
    return len(bins)


def test_bin_completion_reaches_the_fewest_bins():
    rng, better = random.Random(7), 0
    for trial in range(160):
        capacity = rng.choice([20, 50, 100])
        sizes = [rng.randint(1, capacity) if trial % 2 else rng.randint(capacity // 5, capacity // 2) for _ in range(rng.randint(1, 11))]
        least = by_trying_everything(sizes, capacity)
        assert packing.fewest(sizes, capacity) <= least == whole(complete(sizes, capacity), sizes, capacity)
        better += least < len(best_fit(sizes, capacity))
    assert better > 0


def test_completion_beats_best_fit_where_best_fit_fails():
    sizes = [40, 40, 30, 30, 30, 30]  # 200 in all
    assert len(best_fit(sizes, 100)) == 3 and len(complete(sizes, 100)) == 2


def subsets(counts, room):
    """All fillings of the room."""
    out = [()]
    for s, n in sorted(counts.items(), reverse=True):
        out = [(*f, *(s,) * k) for f in out for k in range(n + 1) if sum(f) + s * k <= room]
    return out


def stands_for(one, other):
    """By trying everything, whether the other's pieces can be dealt to the pieces of one."""
    if not other:
        return True
    return any(one[i] >= other[0] and stands_for((*one[:i], one[i] - other[0], *one[i + 1 :]), other[1:]) for i in range(len(one)))


def test_fillings_are_undominated_and_none_is_missing():
    rng = random.Random(5)
    for _ in range(60):
        counts, room = Counter(rng.randint(3, 30) for _ in range(rng.randint(1, 8))), rng.randint(5, 60)
        got, every = fillings(counts, room, 1000, Budget(10**6)), subsets(counts, room)
        assert [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)
        assert all(sorted(f, reverse=True) == list(f) and f in every for f in got)
        for f in every:
            assert any(stands_for(g, f) for g in got)
        assert not any(stands_for(g, f) for i, f in enumerate(got) for g in got[:i])
        sizes = sorted(s for s in counts if s <= room)
        sums = {sum(f) for f in every}
        assert {s for s in range(room + 1) if reachable(counts, sizes, room)[-1] >> s & 1} == sums
    assert fillings(Counter([10, 20, 30, 40]), 40, 6, Budget(99)) == [(40,)]
    assert fillings(Counter([10, 20]), 5, 6, Budget(99)) == [()]


def test_dominance():
    assert dominates((50,), (30, 20)) and dominates((30, 20), (30, 10, 10)) and dominates((5,), ())
    assert not dominates((30, 20), (50,)) and not dominates((26, 24), (25, 25)) and not dominates((), (1,))


def test_large_groups_end_soon_and_near_the_bound():
    rng = random.Random(1)
    for sizes, more in (
        ([rng.randint(30, 110) for _ in range(16384)], 0),
        ([rng.randint(30, 110) for _ in range(3000)], 0),
        ([rng.randint(1, 1023) for _ in range(16384)], 20),
        ([rng.randint(1, 9) for _ in range(16384)] + [700] * 50, 0),
        ([200, 210] * 8192, 140),
        ([rng.choice([77, 300, 301, 450]) for _ in range(16384)], 400),
    ):
        began = time.time()
        n = whole(complete(sizes), sizes, 1024)
        assert n <= packing.fewest(sizes) + more and n <= len(best_fit(sizes))
        assert time.time() - began < 30


def check(rows, docs):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    return len(by_seq)


def test_packing_is_whole_and_gapless(spark, odd_docs):
    rows = packed_documents(odd_docs, with_ids=True).collect()
    want = sorted(zlib.crc32(ids_of(r["text"])[a : a + n].tobytes()) for r in odd_docs.collect() for a, n in cuts(len(ids_of(r["text"]))))
    assert sorted(r["ids_crc32"] for r in rows) == want
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    total = sum(r["length"] for r in rows)
    assert check(rows, odd_docs) == -(-total // 1024)
    one = [r for r in rows if r["doc_id"] == 6]
    assert np.array_equal(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in sorted(one, key=lambda r: r["piece"])]), ids_of(odd_docs.where("doc_id = 6").first()["text"]))


def test_empty_table(no_docs):
    assert packed_documents(no_docs).count() == 0


def test_clashing_and_repeated_rows(spark):
    df = spark.createDataFrame([(i % 3, "a few words " * (i % 5)) for i in range(40)], "doc_id long, text string")
    df = df.withColumns({c: F.lit("mine") for c in ("place", "group", "length", "sequence_id", "offset", "piece")})
    rows = packed_documents(df).collect()
    assert len(rows) == 40 and check(rows, df) == 1
    rows = df.select(F.lit(5).cast("long").alias("length"), F.lit(1).alias("place"), F.lit(2).alias("GROUP"))
    out = packing.pack(rows)
    assert out.columns == ["length", "place", "GROUP", "sequence_id", "offset"]
    got = out.collect()
    assert check(got, df) == 1 and {(r["place"], r["GROUP"]) for r in got} == {(1, 2)}


def test_ids_no_float_holds_beside_a_null(spark):
    big = [2**53 + 1, 2**53 + 3, 2**62 + 1]
    docs = spark.createDataFrame([(big[0], "a b c"), (None, "d"), (big[1], None), (3, "e " * 3000), (big[2], "")], "doc_id long, text string").coalesce(1)
    for with_ids in (False, True):
        rows = packed_documents(docs, with_ids=with_ids).collect()
        assert {r["doc_id"] for r in rows} == {*big, None, 3}
        assert sum(r["length"] for r in rows if r["doc_id"] == big[0]) == len(ids_of("a b c"))
