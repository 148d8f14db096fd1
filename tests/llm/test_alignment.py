import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quotemill.llm.alignment import Block, aligned_documents, both_ids, links_table

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def row(doc_id, text):
    return (doc_id, text, "en", "s", None if text is None else len(text))


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_of():
    """The byte each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def tokens(tools, text):
    """(id, start, end) of A's and B's tokens by the two libraries, or none."""
    a, b = tools
    if not text:
        return [], []
    known = byte_of()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(known[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], []
    out = []
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        at, held = 0, []
        for i, p in zip(ids, parts, strict=True):
            held.append((i, at, at + len(p)))
            at += len(p)
        out.append(held)
    return out


def plain(tools, texts):
    """Token by token, pair by pair."""
    docs = [tokens(tools, t) for t in texts]
    linked, holders = [], defaultdict(set)
    for k, (a, b) in enumerate(docs):
        pairs = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        linked.append(pairs)
        for p in pairs:
            holders[p].add(k)
    count = {p: len(s) for p, s in holders.items()}
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (a, b), pairs in zip(docs, linked, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [f"{','.join(str(x[0]) for x in a if lo < x[2] <= hi)}|{','.join(str(y[0]) for y in b if lo < y[2] <= hi)}" for lo, hi in zip([0, *cuts], cuts, strict=False)]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(groups), len(pairs), sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs), sha))
    return out, count


def told(df):
    return Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect())


TEXTS = [
    "the quick brown fox jumps over the lazy dog",
    "The tokenisation of unbelievably long compounds: Donaudampfschifffahrtsgesellschaft!",
    "the the the the fox",
    "",
    None,
    " leading and  double   spaces ",
    "line\nbreak\ttab",
    "ünïcödé 日本語 のテスト 🙂🙃 naïve",
    "x",
    "<s> </s> <unk> <|endoftext|> ▁ <0x41>",
    "1234567890 12:34 3.14159 0xdeadbeef",
    "ﬁ ligature ½ ① ＡＢＣ",  # normalised by some vocabularies
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    " nbsp​zero﻿",
    "the quick brown fox jumps over the lazy dog",
]


@pytest.mark.parametrize("block_bytes", [1, 60, 1 << 22])
def test_against_plain_links(spark, tools, block_bytes):
    want, _ = plain(tools, TEXTS)
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(TEXTS)], DOC_SCHEMA).repartition(3)
    assert told(aligned_documents(docs, block_bytes=block_bytes)) == Counter((k, *w) for k, w in enumerate(want))


def test_real_texts(spark, tools):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 4000").limit(40).collect()]
    want, _ = plain(tools, texts)
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], DOC_SCHEMA).repartition(2)
    assert told(aligned_documents(docs)) == Counter((k, *w) for k, w in enumerate(want))


def test_links_table(spark, tools):
    _, count = plain(tools, TEXTS)
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(TEXTS)], DOC_SCHEMA)
    found = {(r["a"], r["b"]): (r["documents"], r["is_best"]) for r in links_table(docs).collect()}
    assert {p: n for p, (n, _) in found.items()} == count
    for (a, _), (n, best) in found.items():
        assert best == (n == max(m for (x, _), m in count.items() if x == a))


def test_odd_documents(spark, odd_docs, no_docs):
    """Null and repeated ids stay rows of their own, one of them too large for a float; clashing columns aren't looked at."""
    found = aligned_documents(odd_docs.selectExpr("*", "1 as block", "'x' as data", "2 as kind"))
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[k]["n_links"] == by_id[k]["count_sum"] == 0 and by_id[k]["groups_sha256"] == "" for k in (3, 4))
    assert by_id[6]["n_a"] > 60_000
    assert aligned_documents(no_docs).collect() == []
    big = spark.createDataFrame([(2**53 + 1, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    assert Counter(r["doc_id"] for r in aligned_documents(big).collect()) == Counter([2**53 + 1, None, 3])


def test_empty_documents_only(spark):
    docs = spark.createDataFrame([row(1, ""), row(2, None)], DOC_SCHEMA)
    assert told(aligned_documents(docs)) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


def test_groups_with_equal_numbers_are_told_apart(monkeypatch):
    from quotemill.llm import alignment

    ids = both_ids([t for t in TEXTS if t])
    sound = Block(ids).texts()
    monkeypatch.setattr(alignment, "_mixed", lambda ids, place, side: (ids % 3).astype("uint64"))
    forced = Block(ids)
    assert sorted(forced.texts()) == sorted(sound)
    document, group, times = forced.held()
    assert times.sum() == forced.count.sum()
