"""Toxicity by the nearest labelled examples, under exact TF-IDF cosine.

A text's terms are all its words and their beginnings, hashed to DIMENSIONS numbers; none is left
out. A term's weight is its inverse document frequency over all documents times how much it tells
about toxicity (the information that its presence gives among the learning rows, plus TELLS_LEAST,
so that terms that tell nothing still count). Vectors are (1 + ln tf) times that, at unit length.

The examples' vectors make an inverted index in blocks: for each term and block the largest weight
is kept, so that the largest cosine a block can give is known beforehand. Blocks are scored from
the most promising on until none of the rest can have a nearer example: the nearest are found
exactly, with all that are as near as the last one. Their votes, weighted by the cosine to the
power POWER and smoothed by the share of toxic examples, are mapped to the score by a logistic
curve fitted on labelled rows that are not in the index. Ids of the nearest are the evidence.

Labelled texts are told apart by a hash of the text, so that no id has a say in a score.
LEARNING_ROWS of them at most are learned from, a fifth of these (CALIBRATION_ROWS at most) kept for
the curve, and EXAMPLES of the others are in the index, which is some tens of MB whatever the corpus
and is broadcast. Document frequencies are counted over all documents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import staged

#: Labelled texts that are learned from, those among them that the curve is fitted on, and examples in the index, at most each: those with the smallest hash.
LEARNING_ROWS, CALIBRATION_ROWS, EXAMPLES = 16384, 2048, 1024
DIMENSIONS = 1 << 18
#: Beginnings of words, in characters.
PREFIXES = (3, 4, 5, 6)
TELLS_LEAST = 0.05
NEIGHBOURS = 15
POWER = 4
#: The share of toxic examples counts as a neighbour of this weight.
PRIOR_WEIGHT = 0.1
#: Examples of a block; terms in a larger share of the examples than FREQUENT are held as full rows.
BLOCK, FREQUENT = 128, 0.03
#: Cosines nearer to each other than this are equal.
TIE = 1e-6
#: Texts that are scored at once.
PART = 128


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters or marks on them."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edge, term, count): the terms of text k are those from edge[k] to edge[k + 1], rising, with how often each occurs.

    A term is the number of a word or of one of its beginnings, by its length and the sum of its
    code points times powers of a number, which sums over the whole batch give for all at once.
    """
    lowered = [t.lower() for t in texts]
    code = np.frombuffer(" ".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    inside = np.r_[False, _letters()[code], False]
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, length = turn[::2], turn[1::2] - turn[::2]
    up, down = _powers(1 << max(16, int(len(code)).bit_length()))
    total = np.r_[np.uint64(0), np.cumsum(code * up[: len(code)], dtype=np.uint64)]
    text = np.searchsorted(ends, start, side="right")
    keys = []
    for n in (0, *PREFIXES):
        at = np.flatnonzero(length > n) if n else np.arange(len(start))
        stop = start[at] + (n if n else length[at])
        number = (total[stop] - total[start[at]]) * down[start[at]] + np.uint64(n)
        number = (number ^ (number >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append(text[at] * DIMENSIONS + (number >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return np.searchsorted(key, np.arange(len(texts) + 1) * DIMENSIONS), key % DIMENSIONS, count


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, rows: int = LEARNING_ROWS) -> DataFrame:
    """hash, doc_id, toxic, text for at most ``rows`` labelled texts, none of them from a held-out row; one labelled both ways counts as toxic."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("known")).agg(F.max("toxic").alias("toxic"))
    thin = docs.select("doc_id", F.xxhash64("text").alias("hash")).join(known, F.col("doc_id") == F.col("known"))
    chosen = thin.groupBy("hash").agg(F.min("doc_id").alias("example_id"), F.max("toxic").alias("toxic")).orderBy("hash").limit(rows)
    found = docs.join(F.broadcast(chosen), (F.col("doc_id") == F.col("example_id")) & (F.xxhash64("text") == F.col("hash")))  # LEARNING_ROWS short rows at most
    return staged(found.select("hash", "doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), "text").dropDuplicates(["hash"]), "learning")


def _counted(rows: DataFrame, kinds: int) -> np.ndarray:
    """For each value of column ``kind`` below ``kinds``, in how many texts each term is; the last number of each is that of the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((kinds, DIMENSIONS + 1), np.int64)
        for rows in batches:
            for kind, texts in rows.groupby("kind")["text"]:
                for lo in range(0, len(texts), PART):
                    part = texts.iloc[lo : lo + PART].tolist()
                    n[kind, :-1] += np.bincount(terms_of(part)[1], minlength=DIMENSIONS)
                    n[kind, -1] += len(part)
        kind, term = np.nonzero(n)
        yield pd.DataFrame({"kind": kind, "term": term, "n": n[kind, term]})

    got = rows.select("kind", "text").mapInPandas(run, "kind int, term int, n long").groupBy("kind", "term").agg(F.sum("n").alias("n")).toArrow()  # a number for each kind and term at most
    out = np.zeros((kinds, DIMENSIONS + 1), np.int64)
    out[got.column("kind").to_numpy(), got.column("term").to_numpy()] = got.column("n").to_numpy()
    return out


def telling(with_toxic: np.ndarray, with_other: np.ndarray, rate: float, weight: float = 4.0) -> np.ndarray:
    """How much a term's presence tells: the divergence of the share of toxic rows that have it, smoothed, from the rate of all."""
    p = (with_toxic + rate * weight) / (with_toxic + with_other + weight)
    return p * np.log(p / rate) + (1 - p) * np.log((1 - p) / (1 - rate))


def unit(edge: np.ndarray, term: np.ndarray, count: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The terms' weights in vectors of unit length."""
    w = (1 + np.log(count)) * weights[term]
    of = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    return w / np.sqrt(np.bincount(of, weights=w * w, minlength=len(edge) - 1))[of]


class Index:
    """Example vectors in blocks, with the largest weight of every term in each block."""

    def __init__(self, edge: np.ndarray, term: np.ndarray, weight: np.ndarray, toxic: list[int], ids: list, block: int = BLOCK, dimensions: int = DIMENSIONS) -> None:
        size = np.diff(edge)
        strongest = [int(term[a + weight[a:b].argmax()]) if b > a else -1 for a, b in zip(edge[:-1], edge[1:], strict=True)]
        order = np.argsort(strongest, kind="stable")  # neighbours in the index are alike
        self.block, self.blocks = block, -(-len(order) // block)
        self.toxic, self.ids = np.array(toxic, np.float64)[order], [ids[k] for k in order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        example = np.repeat(place, size)
        known = np.unique(term)
        self.row = np.full(dimensions, -1, np.int64)
        self.row[known] = np.arange(len(known))
        term = self.row[term]
        self.largest = np.zeros((len(known), self.blocks))
        np.maximum.at(self.largest, (term, example // block), weight)
        # terms of many examples are rows of a full matrix, the others postings by block and term
        often = np.flatnonzero(np.bincount(term, minlength=len(known)) > max(8, FREQUENT * len(order)))
        self.full_row = np.full(len(known), -1, np.int64)
        self.full_row[often] = np.arange(len(often))
        self.full = np.zeros((len(often), self.blocks * block), np.float32)
        at = self.full_row[term]
        self.full[at[at >= 0], example[at >= 0]] = weight[at >= 0]
        own = np.flatnonzero(at < 0)
        place = (example[own] // block) * len(known) + term[own]
        own, place = own[np.argsort(place, kind="stable")], np.sort(place)
        self.starts = np.searchsorted(place, np.arange(self.blocks * len(known) + 1))
        self.posted, self.posted_weight = example[own] % block, weight[own]
        self.rate = (sum(toxic) + 1) / (len(toxic) + 4)

    def scores(self, edge: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Cosines of vectors and examples, -1 where a block wasn't scored: it has none among the k nearest.

        Every vector goes through the blocks from its most promising one on, until no other block can
        have a cosine as large as its k-th best so far.
        """
        n, examples, known = len(edge) - 1, self.blocks * self.block, len(self.full_row)
        out = np.full((n, examples), -1.0, np.float32)
        if not self.blocks or not known:
            return out
        row, of = self.row[term], np.repeat(np.arange(n), np.diff(edge))
        of, q, row = of[row >= 0], weight[row >= 0], row[row >= 0]
        edge = np.searchsorted(of, np.arange(n + 1))
        bound = np.zeros((n, self.blocks))
        some = np.flatnonzero(np.diff(edge))
        if len(some):
            bound[some] = np.add.reduceat(q[:, None] * self.largest[row], edge[some], axis=0)
        full = self.full_row[row]
        dense = np.zeros((n, len(self.full)), np.float32)
        dense[of[full >= 0], full[full >= 0]] = q[full >= 0]
        dense = (dense @ self.full).reshape(n, self.blocks, self.block)
        of, q, row = of[full < 0], q[full < 0], row[full < 0]
        order, last, live = np.argsort(-bound, axis=1, kind="stable"), np.full(n, -1.0), np.ones(n, bool)
        for turn in range(self.blocks):
            block = order[:, turn]
            best = bound[np.arange(n), block]
            live &= (best > 0) & (best >= last - TIE)
            if not live.any():
                break
            mine = live[of]
            at = block[of[mine]] * known + row[mine]
            lo = self.starts[at]
            times = self.starts[at + 1] - lo
            posting = np.repeat(lo - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum()) if len(at) else np.empty(0, np.int64)
            cell = np.repeat(of[mine], times) * self.block + self.posted[posting]
            score = np.bincount(cell, weights=np.repeat(q[mine], times) * self.posted_weight[posting], minlength=n * self.block).reshape(n, self.block)
            who = np.flatnonzero(live)
            out.reshape(n, self.blocks, self.block)[who, block[who]] = score[who] + dense[who, block[who]]
            if examples > k:
                last[live] = np.partition(out[live], -k, axis=1)[:, -k]
        return out

    def nearest(self, edge: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """For each vector: cosines of the k nearest with a term in common and of all as near as the last of them, 0 for others; and the positions of the three nearest."""
        s = self.scores(edge, term, weight, k)
        if not s.shape[1]:
            return s.astype(np.float64), np.empty((len(s), 0), np.int64)
        last = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -1.0)
        near = np.where((s > TIE) & (s >= last[:, None] - TIE), s, 0).astype(np.float64)
        return near, np.argsort(-near, axis=1, kind="stable")[:, :3]

    def votes(self, edge: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, list[list[int]]]:
        """For each vector the share of toxic neighbours, weighted and smoothed, and the ids of the three nearest."""
        near, first = self.nearest(edge, term, weight, k)
        power = near**POWER
        toxic = np.zeros(near.shape[1])
        toxic[: len(self.toxic)] = self.toxic
        share = (power @ toxic + PRIOR_WEIGHT * self.rate) / (power.sum(axis=1) + PRIOR_WEIGHT)
        return share, [[self.ids[p] for p in f if near[i, p] > 0] for i, f in enumerate(first)]


def fit_curve(votes: np.ndarray, toxic: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """(slope, intercept) of the chance of a toxic label over the vote's log odds; drawn toward (1, 0), and that where a class is missing."""
    curve = np.array([1.0, 0.0])
    if len(np.unique(toxic)) < 2:
        return 1.0, 0.0
    x = np.stack([np.log(votes / (1 - votes)), np.ones(len(votes))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2), x.T @ (toxic - p) - ridge * (curve - [1.0, 0.0]))
        curve = curve + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(curve[0], 0.0)), float(curve[1])


class Model:
    """Term weights, index and curve.

    df: in how many documents each term is, and their number last; counts: the same for learning
    rows that are toxic and for the others; known and curve: (text, toxic, id) of the rows in the
    index and of those the curve is fitted on.
    """

    def __init__(self, df: np.ndarray, counts: np.ndarray, known: list, curve: list, neighbours: int = NEIGHBOURS) -> None:
        rate = (counts[1, -1] + 1) / (counts[:, -1].sum() + 4)
        self.weights = (np.log((df[-1] + 1) / (df[:-1] + 1)) + 1) * (TELLS_LEAST + telling(counts[1, :-1], counts[0, :-1], rate))
        edge, term, count = terms_of([t for t, _, _ in known])
        self.index = Index(edge, term, unit(edge, term, count, self.weights), [y for _, y, _ in known], [i for _, _, i in known])
        self.neighbours, self.slope, self.intercept = neighbours, 1.0, 0.0
        votes = [self._votes([t for t, _, _ in curve[lo : lo + PART]])[0] for lo in range(0, len(curve), PART)]
        if votes:
            self.slope, self.intercept = fit_curve(np.concatenate(votes), np.array([y for _, y, _ in curve], np.float64))

    def _votes(self, texts: list[str]) -> tuple[np.ndarray, list[list]]:
        edge, term, count = terms_of(texts)
        return self.index.votes(edge, term, unit(edge, term, count, self.weights), self.neighbours)

    def judge(self, texts: list[str]) -> tuple[np.ndarray, list[list]]:
        """Scores of texts and the ids of their nearest examples."""
        share, near = self._votes(texts)
        return 1 / (1 + np.exp(-(self.slope * np.log(share / (1 - share)) + self.intercept))), near


def fitted(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, neighbours: int = NEIGHBOURS) -> Model:
    """The model for docs (doc_id, text)."""
    rows = learning_rows(docs, labels)
    for_curve = F.pmod(F.col("hash"), F.lit(5)) == 4
    some = lambda part, n: [(r["text"], r["toxic"], r["doc_id"]) for r in part.orderBy("hash").limit(n).collect()]  # noqa: E731  EXAMPLES and CALIBRATION_ROWS texts at most
    df = _counted(docs.select(F.lit(0).alias("kind"), "text"), 1)[0]
    counts = _counted(rows.where(~for_curve).select(F.col("toxic").alias("kind"), "text"), 2)
    return Model(df, counts, some(rows.where(~for_curve), examples), some(rows.where(for_curve), CALIBRATION_ROWS), neighbours)


def toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, neighbours: int = NEIGHBOURS) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (ids of the nearest examples) for each row of docs (doc_id, text).

    Only the text goes into a score. A text without words, null and empty ones among them, gets the
    score that the share of toxic examples maps to. Without labels every score is 0.25. Null ids are
    never held out. Repeated rows are scored each time; other columns aren't looked at, whatever
    their names; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fitted(rows, labels, examples, neighbours))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.value.judge
        for batch in batches:
            for lo in range(0, batch.num_rows, PART):
                part = batch.slice(lo, PART)
                scores, near = judge(part.column("text").to_pylist())
                ids = part.column("doc_id")  # as they come: a float wouldn't hold them all
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "held_out": part.column("held_out"), "score": scores, "predicted": pa.array(scores >= 0.5).cast(pa.int32()), "evidence": pa.array(near, pa.list_(ids.type))})

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, evidence array<{kind}>")
