"""Packing token sequences by bin completion.

Documents become tokens where they are read; only thin rows (document, piece, length, digest)
travel. Pieces are dealt to groups of about ``group_rows``, whatever their document, and each
group is packed by itself: branch and bound over the fillings that complete the bin of the largest
piece left, with best-fit decreasing as the first incumbent. A group may use one sequence more
than it would as part of a larger one, so that all groups together are within one sequence in
several thousand of the fewest possible.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import free, staged

CAPACITY = 1024
END = 2
GROUP_ROWS = 16384
#: Fillings tried for a bin, in one search after the other; and steps that a search may take for each piece.
WIDTHS, SEARCH_STEPS = (2, 8, 32), 16
TOKENIZER = "byte_bpe_50k"
#: Pieces of a frame that a task hands back.
FRAME_ROWS = 2048


@lru_cache(maxsize=2)
def encoder(name: str) -> tiktoken.Encoding:
    """The byte-level BPE ``name``: the ids of its JSON file, by the library that is four times as fast on the same vocabulary."""
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


def ids_of(text: str | None, name: str = TOKENIZER) -> np.ndarray:
    """The text's ids, unsigned 32-bit, END last; a null text counts as empty."""
    ids = encoder(name).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, np.uint32(END)).astype("<u4")


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece: all full but the first."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long{ids}"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each document's pieces; with_ids: and their ids, as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            out: list[tuple] = []

            def done() -> pa.RecordBatch:
                row, piece, start, length, crc, *parts = (list(c) for c in zip(*out, strict=True))
                held = {"doc_id": doc_ids.take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}  # ids never leave Arrow: a float wouldn't hold them all
                return pa.RecordBatch.from_pydict(held | ({"ids": pa.array(parts[0], pa.binary())} if with_ids else {}))

            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = ids_of(text, tokenizer)
                data = ids.tobytes()
                for k, (start, n) in enumerate(cuts(len(ids), capacity)):
                    part = data[4 * start : 4 * (start + n)]
                    out.append((row, k, start, n, zlib.crc32(part)) + (part,) * with_ids)
                if len(out) >= FRAME_ROWS:
                    yield done()
                    out = []
            if out:
                yield done()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, PIECES.format(id=kind, ids=", ids binary" if with_ids else ""))


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Best-fit decreasing: each size goes where it leaves the least room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    open_rooms = 0  # bit r: some bin has room r
    for size in sorted(sizes, reverse=True):
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(size)
        if room > size:
            by_room.setdefault(room - size, []).append(at)
            open_rooms |= 1 << (room - size)
    return bins


def reachable(counts: dict[int, int], sizes: list[int], room: int) -> list[int]:
    """For each k, the sums up to ``room`` that the first k sizes make, as bits; each size s can be used counts[s] times."""
    full, sums, out = (1 << (room + 1)) - 1, 1, [1]
    for s in sizes:
        if sums != full:
            left, step = min(counts[s], room // s), 1
            while left > 0:
                n = min(step, left)
                sums |= (sums << (s * n)) & full
                left, step = left - n, 2 * step
        out.append(sums)
    return out


def dominates(one: tuple[int, ...], other: tuple[int, ...], tries: int = 64) -> bool:
    """Whether each piece of ``one`` can stand in for a set of the other's pieces, all of them in the end; no, if that isn't found soon."""
    if sum(one) < sum(other) or (other and (not one or max(other) > max(one))):
        return False
    rooms, pieces = sorted(one, reverse=True), sorted(other, reverse=True)

    def go(k: int) -> bool:
        nonlocal tries
        if k == len(pieces):
            return True
        tries -= 1
        for i in range(len(rooms)):
            if tries > 0 and rooms[i] >= pieces[k] and rooms[i] not in rooms[:i]:
                rooms[i] -= pieces[k]
                if go(k + 1):
                    return True
                rooms[i] += pieces[k]
        return False

    return go(0)


class Budget:
    """Steps that are left to a group's searches."""

    def __init__(self, steps: int) -> None:
        self.left = steps


def fillings(counts: dict[int, int], room: int, width: int, budget: Budget, slack: int | None = None, keep_small: bool = True) -> list[tuple[int, ...]]:
    """Up to ``width`` undominated fillings of ``room``, of any number of pieces, least waste first.

    Of equal waste comes first, with keep_small, the one whose smallest piece is largest, so that small
    pieces are left for rooms that nothing else fills; without, the one with the largest pieces. The sums that the sizes can make are known beforehand, so that every step leads to a filling.
    A size that fits exactly stands for all others. Fillings with more waste than ``slack`` aren't
    asked for, nor any more when the budget is spent; the first one is always found.
    """
    if counts.get(room):
        return [(room,)]
    sizes = sorted((s for s in counts if s <= room), reverse=keep_small)
    sums = reachable(counts, sizes, room)
    found: list[tuple[int, ...]] = []
    fills = sums[-1]

    def of(total: int, k: int) -> Iterator[tuple[int, ...]]:
        """Fillings of exactly ``total`` by the first k sizes."""
        if not total:
            yield ()
            return
        for at in range(k) if keep_small else range(k - 1, -1, -1):
            s = sizes[at]
            if s > total or not sums[at + 1] >> total & 1:
                continue
            budget.left -= 1
            if found and budget.left <= 0:
                return
            most = min(counts[s], total // s)
            for n in range(1, most + 1) if keep_small else range(most, 0, -1):
                if sums[at] >> (total - s * n) & 1:
                    for rest in of(total - s * n, at):
                        yield (*rest, *(s,) * n) if keep_small else (*(s,) * n, *rest)

    while fills and len(found) < width:
        total = fills.bit_length() - 1
        if found and (budget.left <= 0 or slack is not None and room - total > slack):
            break
        seen = 0
        for f in of(total, len(sizes)):
            budget.left -= 1
            seen += 1
            if not any(dominates(g, f) for g in found):
                found.append(f)
            if len(found) >= width or budget.left <= 0 or seen >= 4 * width:
                break
        fills ^= 1 << total
    return found


def fewest(sizes: list[int], capacity: int = CAPACITY) -> int:
    """A lower bound on the bins: for each size up to half a bin, how many the sizes from there on need at least.

    Sizes over half a bin need one each; what they leave free takes the rest only where it can fit.
    """
    counts, total = [0] * (capacity + 1), -(-sum(sizes) // capacity)
    for s in sizes:
        counts[s] += 1
    half, best = capacity // 2, total
    over, free_room = sum(counts[half + 1 :]), sum(n * (capacity - s) for s, n in enumerate(counts) if s > half)
    rest = sum(s * n for s, n in enumerate(counts[: half + 1]))
    for least in range(1, half + 1):  # pieces of ``least`` and more only
        best = max(best, over + max(0, -(-(rest - free_room) // capacity)))
        rest -= least * counts[least]
        free_room -= least * counts[capacity - least] if capacity - least > half else 0
    return best


def complete(sizes: list[int], capacity: int = CAPACITY, widths: tuple[int, ...] = WIDTHS, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """Bins for the sizes: branch and bound over fillings around the largest size left.

    The incumbent is the best packing so far: best-fit decreasing's, then those of the fullest
    fillings one after the other, in either order; searches go by the better one. A branch ends when its waste leaves no way to beat the incumbent;
    a search ends at the lower bound, or when it has used up ``steps`` for each piece.
    """
    best, bound = best_fit(sizes, capacity), fewest(sizes, capacity)
    keep_small, least = True, None
    for order in (True, False):
        if len(best) > bound:
            found = _descent(sizes, capacity, order)
            if least is None or len(found) < least:
                keep_small, least = order, len(found)
            best = min(best, found, key=len)
    for width in widths:
        if len(best) > bound:
            best = _search(sizes, best, capacity, width, bound, Budget(steps * len(sizes) + 4096), keep_small)
    return best


def _descent(sizes: list[int], capacity: int, keep_small: bool) -> list[list[int]]:
    """The fullest filling around the largest size left, again and again."""
    counts, bins = Counter(sizes), []
    while counts:
        first = max(counts)
        counts -= Counter([first])
        bins.append([first, *fillings(counts, capacity - first, 1, Budget(0), keep_small=keep_small)[0]])
        counts -= Counter(bins[-1][1:])
    return bins


def _search(sizes: list[int], best: list[list[int]], capacity: int, width: int, bound: int, budget: Budget, keep_small: bool) -> list[list[int]]:
    total = sum(sizes)
    counts: dict[int, int] = dict(Counter(sizes))

    def take(bin_: list[int], sign: int) -> None:
        for s in bin_:
            n = counts.get(s, 0) + sign
            if n:
                counts[s] = n
            else:
                del counts[s]

    path: list[list[int]] = []
    waste = 0
    stack: list[Iterator[list[int]]] = []

    def slack() -> int:
        """Waste that may still be added by a packing that beats the incumbent."""
        return (len(best) - 1) * capacity - total - waste

    def options() -> Iterator[list[int]]:
        first = max(counts)
        take([first], -1)
        fills = fillings(counts, capacity - first, width, budget, slack(), keep_small)
        take([first], 1)
        return iter([[first, *f] for f in fills])

    def back() -> None:
        nonlocal waste
        waste -= capacity - sum(path[-1])
        take(path.pop(), 1)

    stack.append(options())
    while stack and budget.left > 0:
        bin_ = next(stack[-1], None)
        if bin_ is None or capacity - sum(bin_) > slack():
            stack.pop()  # options come with the least waste first, so that none of the others does better
            if path:
                back()
            continue
        take(bin_, -1)
        path.append(bin_)
        waste += capacity - sum(bin_)
        if counts:
            stack.append(options())
            continue
        best = [list(b) for b in path]
        if len(best) <= bound:
            break
        back()
    return best


def pack(rows: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """rows (with column length) with sequence_id and offset, gapless from 0 in each sequence.

    Rows are dealt by their place in the table that is written first, so that hot or repeated ids
    don't meet in one group. No rows give no rows.
    """
    table = staged(rows, "pieces")
    groups = max(1, -(-table.count() // group_rows))
    place, group = free(rows, "place", "group")

    def run(key: tuple, part: pa.Table) -> pa.Table:
        part = part.take(pa.array(np.argsort(part.column(place).to_numpy(), kind="stable")))
        waiting: dict[int, list[int]] = {}
        sizes = part.column("length").to_pylist()
        for at, size in enumerate(sizes):
            waiting.setdefault(size, []).append(at)
        bins = complete([s for s in sizes if s < capacity], capacity) + [[capacity] for _ in waiting.get(capacity, [])]
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for k, bin_ in enumerate(bins):
            at = 0
            for size in bin_:
                row = waiting[size].pop()
                sequence[row], offset[row] = (key[0].as_py() << 32) + k, at
                at += size
        return part.drop_columns([place, group]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    dealt = table.withColumn(place, F.monotonically_increasing_id()).withColumn(group, F.pmod(F.xxhash64(place), F.lit(groups)))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", sequence_id long, offset long"
    return dealt.groupBy(group).applyInArrow(run, schema)


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece of every document and its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null and empty texts are one piece of the end token. Rows with null or repeated ids are packed
    like others. Other columns of docs aren't looked at, whatever their names. An empty table gives
    an empty result.
    """
    return pack(pieces(docs, id_col, text_col, with_ids=with_ids))
