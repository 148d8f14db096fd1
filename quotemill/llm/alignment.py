"""Alignment of two tokenizers by a group dictionary.

A document's bytes are cut wherever a token of A and a token of B end together. Between two cuts
stands a group: some ids of A over the same bytes as some ids of B. The same groups come again and
again, so they are interned: links (pairs of an A and a B token whose byte ranges overlap) are
expanded once for each distinct group, weighed by how often it stands in a document, and looked up
by the group's key.

Documents are tokenized where they are read, in blocks of about BLOCK_BYTES. A block keeps one thin
row a document (its distinct groups by their place in the block's dictionary, with their counts),
one row a distinct group, and one row a linked pair of ids with the number of the block's documents
that hold it. Only these are shuffled, so that a frequent group is sent once a block and not once a
document. Pair counts are sums over blocks. Every distinct group of the corpus gets its numbers
once, by a join of its links with the pair counts; the numbers go back to the blocks by the group's
key, and from there to the documents.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import staged
from quotemill.llm.packing import encoder

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k", "piece_bpe_32k"
#: Text bytes of a block; a longer document is a block by itself.
BLOCK_BYTES = 4 << 20
#: What B writes for a space.
SPACE_MARK = "▁"


@lru_cache(maxsize=2)
def vocabulary_a(name: str) -> tuple[list[bytes], np.ndarray]:
    """The bytes of A's ids, and how many there are."""
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    held = [ranks.get(k, b"") for k in range(max(ranks) + 1)]
    return held, np.array(list(map(len, held)), np.int64)


@lru_cache(maxsize=2)
def pieces_b(name: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))


@lru_cache(maxsize=2)
def vocabulary_b(name: str) -> tuple[list[bytes], np.ndarray]:
    """The bytes of B's ids, and how many there are."""
    b = pieces_b(name)
    held = [bytes([int(b.id_to_piece(k)[3:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace(SPACE_MARK, " ").encode() for k in range(b.get_piece_size())]
    return held, np.array(list(map(len, held)), np.int64)


NO_IDS = np.empty(0, np.int64)


def both_ids(texts: list[str | None], name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> list[tuple[np.ndarray, np.ndarray]]:
    """(A's ids, B's ids) of each text; none for a text that is null or empty, or whose bytes aren't those of its tokens."""
    (bytes_a, _), (bytes_b, _), a = vocabulary_a(name_a), vocabulary_b(name_b), encoder(name_a)
    out = []
    for text, b_ids in zip(texts, pieces_b(name_b).encode([t or "" for t in texts], num_threads=1), strict=True):
        whole = f" {text}".encode("utf-8", "surrogatepass") if text else b""
        if not text or b"".join([bytes_b[k] for k in b_ids]) != whole:
            out.append((NO_IDS, NO_IDS))
            continue
        a_ids = a.encode_to_numpy(f" {text}", disallowed_special=()).astype(np.int64)
        same = b"".join([bytes_a[k] for k in a_ids.tolist()]) == whole
        out.append((a_ids, np.array(b_ids, np.int64)) if same else (NO_IDS, NO_IDS))
    return out


def _mixed(ids: np.ndarray, place: np.ndarray, side: int) -> np.ndarray:
    """A 64-bit number of an id at its place in a group."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(side)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def expanded(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, tokens: np.ndarray, a_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``tokens``, pair) of the links of the A tokens at the positions ``tokens``; a pair is A's id times 2^32 plus B's."""
    first = np.searchsorted(b_end, a_end[tokens] - a_len[tokens], side="right")
    times = np.searchsorted(b_end, a_end[tokens] - 1, side="right") - first + 1
    of = np.repeat(np.arange(len(tokens)), times)
    at = np.arange(times.sum()) + np.repeat(first - np.cumsum(times) + times, times)
    return of, (a[tokens][of] << 32) | b[at]


class Block:
    """The groups of some documents: each distinct one once, and by document which, how often and in which order."""

    def __init__(self, ids: list[tuple[np.ndarray, np.ndarray]], name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> None:
        len_a, len_b = vocabulary_a(name_a)[1], vocabulary_b(name_b)[1]
        self.n_a, self.n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
        a, b = (np.concatenate([NO_IDS, *[x[side] for x in ids]]) for side in (0, 1))
        a_len, b_len = len_a[a], len_b[b]
        a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
        total = int(a_end[-1]) if len(a) else 0
        ends_a, ends_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        ends_a[a_end], ends_b[b_end] = True, True
        cut_a, cut_b = ends_b[a_end], ends_a[b_end]  # tokens that a group ends with
        stop_a, stop_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        start_a, start_b = np.r_[0, stop_a[:-1]].astype(np.int64), np.r_[0, stop_b[:-1]].astype(np.int64)
        self.edge = np.searchsorted(stop_a, np.r_[0, np.cumsum(self.n_a)], side="right")  # document k has the groups edge[k] to edge[k + 1]
        self.count = np.diff(self.edge)
        of_a, of_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        place_a, place_b = np.arange(len(a)) - start_a[of_a] if len(a) else NO_IDS, np.arange(len(b)) - start_b[of_b] if len(b) else NO_IDS
        n = len(stop_a)
        if n:
            number = np.add.reduceat(_mixed(a, place_a, 1), start_a) ^ np.add.reduceat(_mixed(b, place_b, 2), start_b)
            self.code, _ = pd.factorize(number)
            head = np.full(int(self.code.max()) + 1, n)
            np.minimum.at(head, self.code, np.arange(n))
            alike = head[self.code]
            same = ((stop_a - start_a) == (stop_a - start_a)[alike]).all() and ((stop_b - start_b) == (stop_b - start_b)[alike]).all()
            same = same and (a == a[start_a[alike][of_a] + place_a]).all() and (b == b[start_b[alike][of_b] + place_b]).all()
            if not same:  # two groups with one number: told apart by their ids
                known: dict[tuple[bytes, bytes], int] = {}
                self.code = np.array([known.setdefault((a[p:q].tobytes(), b[r:s].tobytes()), len(known)) for p, q, r, s in zip(start_a, stop_a, start_b, stop_b, strict=True)])
                head = np.full(len(known), n)
                np.minimum.at(head, self.code, np.arange(n))
        else:
            self.code, head = NO_IDS, NO_IDS
        self.ids_a = [a[p:q] for p, q in zip(start_a[head].tolist(), stop_a[head].tolist(), strict=True)] if n else []
        self.ids_b = [b[p:q] for p, q in zip(start_b[head].tolist(), stop_b[head].tolist(), strict=True)] if n else []
        width = (stop_a - start_a)[head] if n else NO_IDS
        tokens = np.repeat(start_a[head] - np.cumsum(width) + width, width) + np.arange(width.sum()) if n else NO_IDS
        of, self.link = expanded(a, b, a_end, b_end, tokens, a_len)
        self.link_group = np.repeat(np.arange(len(head)), width)[of] if n else NO_IDS

    def texts(self) -> list[str]:
        """Each distinct group as text, A's ids before B's."""
        join = lambda ids: ",".join(map(str, ids.tolist()))
        return [f"{join(x)}|{join(y)}" for x, y in zip(self.ids_a, self.ids_b, strict=True)]

    def keys(self) -> list[bytes]:
        """Each distinct group as bytes: how many ids of A there are, A's ids, B's ids, as unsigned 32, 16 and 16 bits."""
        return [np.uint32(len(x)).tobytes() + x.astype("<u2").tobytes() + y.astype("<u2").tobytes() for x, y in zip(self.ids_a, self.ids_b, strict=True)]

    def held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, distinct group, times), by document."""
        groups = max(1, len(self.ids_a))
        found, times = np.unique(np.repeat(np.arange(len(self.count)), self.count) * groups + self.code, return_counts=True)
        return found // groups, found % groups, times

    def pair_documents(self, document: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, documents): how many documents hold each pair linked, whatever the group."""
        pairs, link = np.unique(self.link, return_inverse=True)
        once = np.unique(self.link_group * max(1, len(pairs)) + link)  # a pair of a group, however often it is linked there
        of, link = once // max(1, len(pairs)), once % max(1, len(pairs))
        edge = np.searchsorted(of, np.arange(len(self.ids_a) + 1))
        times = edge[group + 1] - edge[group]
        at = np.repeat(edge[group] - np.cumsum(times) + times, times) + np.arange(times.sum())
        found = np.unique(np.repeat(document, times) * max(1, len(pairs)) + link[at])
        return pairs, np.bincount(found % max(1, len(pairs)), minlength=len(pairs))


#: kind 0: a document; 1: a distinct group of a block; 2: a pair of ids of a block.
PARTS = "kind int, block long, doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, data binary, place int, a int, b int, n long"


def _rows(kind: int, size: int, at: int, id_type: pa.DataType, **held) -> pa.RecordBatch:
    """size rows of PARTS, null where nothing is held."""
    types = [("kind", pa.int32()), ("block", pa.int64()), ("doc_id", id_type), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("data", pa.binary()), ("place", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]
    held |= {"kind": np.full(size, kind), "block": np.full(size, at)}
    columns = [x if isinstance(x := held.get(name), pa.Array) else pa.nulls(size, t) if x is None else pa.array(x, t) for name, t in types]
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema(types))


def parts(docs: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of all blocks of docs (doc_id, text)."""

    def block_rows(at: int, doc_ids: pa.Array, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        block = Block(both_ids(texts, name_a, name_b), name_a, name_b)
        names = block.texts()
        named = np.array([*names, ""], object)[:-1]
        document, group, times = block.held()
        first = np.searchsorted(document, np.arange(len(texts) + 1))
        sha, data = [], []
        for k in range(len(texts)):
            own = block.code[block.edge[k] : block.edge[k + 1]]
            sha.append(hashlib.sha256(";".join(named[own].tolist()).encode()).hexdigest() if len(own) else "")
            data.append(np.stack([group[first[k] : first[k + 1]], times[first[k] : first[k + 1]]]).astype("<i4").tobytes())
        keys = block.keys()
        pairs, holders = block.pair_documents(document, group)
        yield _rows(0, len(texts), at, doc_ids.type, doc_id=doc_ids, n_a=block.n_a, n_b=block.n_b, n_groups=block.count, groups_sha256=sha, data=data)
        if keys:
            yield _rows(1, len(keys), at, doc_ids.type, data=keys, place=range(len(keys)))
            yield _rows(2, len(pairs), at, doc_ids.type, a=pairs >> 32, b=pairs & 0xFFFFFFFF, n=holders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, lo, size = batch.column("text").to_pylist(), 0, 0
            for k, text in enumerate(texts):
                size += len(text or "")
                if size >= block_bytes or k + 1 == len(texts):
                    yield from block_rows(at, batch.column("doc_id").slice(lo, k + 1 - lo), texts[lo : k + 1])
                    at, lo, size = at + 1, k + 1, 0

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, PARTS.format(id=kind))


def links_of(keys: DataFrame, name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """data, a, b, times: the links of each distinct group, from its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("data")
            for lo in range(0, len(whole), 8192):
                held = whole.slice(lo, 8192)
                numbers = [np.frombuffer(x, "<u2") for x in held.to_pylist()]
                n_a = [int(x[0]) | int(x[1]) << 16 for x in numbers]
                block = Block([(x[2 : 2 + n].astype(np.int64), x[2 + n :].astype(np.int64)) for x, n in zip(numbers, n_a, strict=True)], name_a, name_b)
                # every key is a document of one group, and a distinct one
                pairs, link = np.unique(block.link, return_inverse=True)
                found, times = np.unique(block.link_group * max(1, len(pairs)) + link, return_counts=True)
                place = np.empty(len(block.ids_a), np.int64)
                place[block.code] = np.arange(len(held))
                pair = pairs[found % max(1, len(pairs))]
                yield pa.RecordBatch.from_pydict({"data": held.take(pa.array(place[found // max(1, len(pairs))])), "a": pa.array(pair >> 32, pa.int32()), "b": pa.array(pair & 0xFFFFFFFF, pa.int32()), "times": pa.array(times, pa.int64())})

    return keys.select("data").mapInArrow(run, "data binary, a int, b int, times long")


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, documents, is_best: in how many documents a pair is linked, and whether no other pair of its A id is in more."""
    counts = rows.where("kind = 2").groupBy("a", "b").agg(F.sum("n").alias("documents"))
    best = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(F.broadcast(best), "a").select("a", "b", "documents", (F.col("documents") == F.col("most")).alias("is_best"))  # best: a row an id of A's vocabulary


def aligned_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of docs.

    Null and empty texts, and texts whose bytes aren't those of their tokens, have zeros and an empty
    groups_sha256. Rows with null or repeated ids are documents of their own. Other columns aren't
    looked at, whatever their names; an empty table gives an empty result.
    """
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(parts(thin, name_a, name_b, block_bytes), "alignment")
    groups = rows.where("kind = 1").select("block", "place", "data")
    links = links_of(groups.select("data").distinct(), name_a, name_b)
    counts = staged(pair_counts(rows), "pairs")
    numbers = links.join(counts, ["a", "b"]).groupBy("data").agg(
        F.sum("times").alias("links"), F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.col("times") * F.col("documents")).alias("total")
    )
    numbers = groups.join(numbers, "data").select(F.col("block").alias("of_block"), "place", "links", "best", "total")
    kind = dict(thin.dtypes)["doc_id"]

    def told(own: pa.Table, found: pa.Table) -> pa.Table:
        n = found.num_rows
        held = np.zeros((3, n), np.int64)
        for k, c in enumerate(("links", "best", "total")):
            held[k, found.column("place").to_numpy()] = found.column(c).to_numpy()
        sums = []
        for data in own.column("data").to_pylist():
            group, times = np.frombuffer(data, "<i4").reshape(2, -1)
            sums.append(held[:, group] @ times.astype(np.int64))
        sums = np.array(sums, np.int64).reshape(-1, 3)
        own = own.select(["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
        for k, c in enumerate(("n_links", "n_best", "count_sum")):
            own = own.append_column(c, pa.array(sums[:, k], pa.int64()))
        return own

    out = rows.where("kind = 0").select("block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "data")
    out = out.groupBy("block").cogroup(numbers.groupBy("of_block")).applyInArrow(told, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def links_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> DataFrame:
    """a, b, documents, is_best: the corpus-wide dictionary from A's ids to B's."""
    return pair_counts(staged(parts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), name_a, name_b), "alignment"))
