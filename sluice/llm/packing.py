"""Packing token sequences by bin completion over the histogram of lengths.

Documents become token pieces inside tasks. How pieces share sequences depends on
their lengths alone, so the search works on the counts of at most ``capacity``
lengths, however many pieces there are: it fills around the largest length with
undominated sets of smaller ones, takes each filling as often as the counts
allow, and prunes branches whose waste cannot beat the best packing so far, which
starts as best fit. Where that leaves a packing above the lower bound, a second
search goes through all sets of any size and all numbers of times. Pieces then read
off their sequence from their rank among the pieces of their length.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cache
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.vectors import Texts, Words, let_go, ragged, slices, span_hashes, split_words, texts
from sluice.session import materialize

#: (length, copies) of one sequence, longest first
Filling = tuple[tuple[int, int], ...]
Packing = list[tuple[int, Filling]]

#: levels of the search whose open choices are held; those above are made again on the way back
LIVE = 16


#: fixed values: characters that are tokens of their own after a letter
TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def with_tails(t: Texts, w: Words) -> Words:
    """Words cut before punctuation that follows one of the letters a-z."""
    tail = np.zeros(256, bool)
    tail[list(TAIL)] = True
    letter = (t.data >= 97) & (t.data <= 122)
    edge = np.flatnonzero(tail[t.data[1:]] & letter[:-1]) + 1
    # a letter that ends one text and punctuation that begins the next are no word
    inside = np.searchsorted(w.start, edge, "right") - 1
    edge = edge[(inside >= 0) & (edge < w.end[np.maximum(inside, 0)]) & (edge > w.start[np.maximum(inside, 0)])] if len(w.start) else edge[:0]
    start = np.sort(np.concatenate([w.start, edge]))
    end = np.sort(np.concatenate([w.end, edge]))
    return Words(start, end, np.searchsorted(start, t.bounds))


class Encoder:
    """Token ids of texts, with the ids of words kept.

    For ``word_bpe_49k.json`` white space always separates tokens, letters are
    lower-cased, and punctuation after a letter is on its own, so a text's ids
    are those of its words and their tails in order. Words are told apart by
    64-bit hashes. The store is bounded and starts again when full.
    """

    def __init__(self, path: str, store_ids: int = 6_000_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = store_ids
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        made = self.tokenizer.encode("\n".join(words), add_special_tokens=False)
        size = np.array([len(w) + 1 for w in words])
        begin = np.cumsum(size) - size
        ids = np.array(made.ids, np.uint32)
        at = np.array(made.offsets, np.int64).reshape(-1, 2)[:, 0]
        owner = np.searchsorted(begin, at, "right") - 1
        length = np.bincount(owner, minlength=len(words))
        start = np.cumsum(length) - length + len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        at = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, at, hashes)
        self.start = np.insert(self.start, at, start)
        self.length = np.insert(self.length, at, length)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the bounds of each text's ids."""
        t = texts(column)
        w = split_words(t)
        if b"<|" not in t.data.tobytes():  # else the names of special tokens may occur
            t = t.lowered()
            w = with_tails(t, w)
        hashes = span_hashes(t.data, w.start, w.end)
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.ids) > self.limit:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = t.data.tobytes()
            words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(w.start[sample[new]], w.end[sample[new]], strict=True)]
            self._learn(distinct[new], words)
        at = np.searchsorted(self.keys, distinct)
        start, length = self.start[at][which], self.length[at][which]
        bounds = np.concatenate([[0], np.cumsum(length)])[w.first]
        return self.ids[ragged(start, length)], bounds


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(df: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Token pieces of every text: ``doc_id, piece, start, length, ids_crc32``.

    A text's ids and ``end_id`` make one piece, or pieces of ``capacity`` ids and
    a rest if there are more. A null text is empty and gives the end id alone.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = encoder(tokenizer)
        for whole in batches:
            for part in slices(whole, limit=2 << 20):
                ids, bounds = model.encode(part.column("text"))
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                size = np.diff(bounds)
                count = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), count)
                piece = ragged(np.zeros(len(size), np.int64), count)
                start = piece * capacity
                length = np.minimum(capacity, size[doc] - start)
                at = bounds[doc] + start
                sums = [crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                arrays = [part.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32))]
                arrays += [pa.array(start), pa.array(length), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])
        let_go()

    chosen = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best fit decreasing, all sequences that look alike at once."""
    rooms: list[int] = []  # ascending, each with its groups
    groups: dict[int, list[list]] = {}  # room -> [times, filling]

    def put(room: int, times: int, filling: tuple) -> None:
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append([times, filling])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                copies = capacity // length
                times, rest = divmod(left, copies)
                if times:
                    put(capacity - copies * length, times, ((length, copies),))
                if rest:
                    put(capacity - rest * length, 1, ((length, rest),))
                break
            room = rooms[k]
            times, filling = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(k)
            copies = min(room // length, left)
            used = min(times, left // copies)
            left -= used * copies
            put(room - copies * length, used, (*filling, (length, copies)))
            if times > used:
                put(room, times - used, filling)
    return [(times, filling) for room in rooms for times, filling in groups[room]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences any packing needs (Martello and Toth's second bound)."""
    lengths = sorted(counts)
    total = sum(n * k for n, k in counts.items())
    best = math.ceil(total / capacity)
    big = [(n, counts[n]) for n in lengths if 2 * n > capacity]
    for cut in [0, *(n for n in lengths if 2 * n <= capacity)]:
        alone = sum(k for n, k in big if n > capacity - cut)
        pairs = [(n, k) for n, k in big if n <= capacity - cut]
        room = sum(k * (capacity - n) for n, k in pairs)
        small = sum(n * counts[n] for n in lengths if cut <= n and 2 * n <= capacity)
        best = max(best, alone + sum(k for _, k in pairs) + max(0, math.ceil((small - room) / capacity)))
    return best


def fillings(lengths: list[int], counts: dict[int, int], room: int, most: int = 3) -> list[tuple[int, ...]]:
    """Undominated sets of up to ``most`` lengths (ascending list) that fit into ``room``, fullest first.

    A set is left out when its lengths can be grouped so that each group fits
    under a length of another set: a shorter last length never beats the longest
    that fits, and a set of several no fuller than a set of fewer hardly ever does.
    These are the most promising sets only; :func:`all_fillings` has the rest.
    """
    found: list[tuple[int, tuple[int, ...]]] = []

    def extend(chosen: tuple[int, ...], room: int, top: int) -> None:
        at = bisect_right(lengths, min(room, top)) - 1
        last = True
        while at >= 0:
            n = lengths[at]
            if chosen.count(n) < counts[n]:
                if last:
                    found.append((room - n, (*chosen, n)))
                    last = False
                if len(chosen) + 1 == most or len(found) > 200:
                    break
                extend((*chosen, n), room - n, n)
            at -= 1

    extend((), room, room)
    found.sort(key=lambda x: (x[0], len(x[1])))
    out: list[tuple[int, ...]] = []
    fewest = most + 1
    for _, chosen in found:
        # fuller or equal sets come first: a later one must be smaller to be of use
        if len(chosen) < fewest or not out:
            out.append(chosen)
            fewest = len(chosen)
    return out


def all_fillings(lengths: list[int], counts: dict[int, int], room: int) -> Iterator[tuple[int, ...]]:
    """Every set of lengths (ascending list) that may be needed to fill ``room``, one after the other.

    Left out are only sets to which a length could be added, and those that end in
    a shorter length than would fit: another set holds each of these, length for length.
    """
    chosen: list[int] = []
    used: dict[int, int] = {}
    # of each length so far: the next place to try, whether one was tried, the room, and whether it is the longest that fits
    open_: list[list] = [[bisect_right(lengths, room) - 1, False, room, True]]
    while open_:
        at, tried, left, longest = open_[-1]
        while at >= 0 and used.get(lengths[at], 0) >= counts[lengths[at]]:
            at -= 1
        if at >= 0:
            n = lengths[at]
            open_[-1][:2] = at - 1, True
            chosen.append(n)
            used[n] = used.get(n, 0) + 1
            open_.append([bisect_right(lengths, min(left - n, n)) - 1, False, left - n, not tried])
            continue
        if not tried and longest:
            yield tuple(chosen)
        open_.pop()
        if chosen:
            used[chosen.pop()] -= 1


def complete(counts: dict[int, int], capacity: int, nodes: int | None = 20_000) -> Packing:
    """The best packing found; stops at the lower bound.

    First the most promising fillings are searched for ``nodes`` steps, then all
    fillings for as many. Without ``nodes`` the second search goes on until no
    better packing is left, which may take exponentially long.
    """
    counts = {n: k for n, k in counts.items() if k}
    if not counts:
        return []
    best, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    for every in (False, True):
        if sum(t for t, _ in best) > bound:
            best = _searched(counts, capacity, best, bound, 20_000 if nodes is None and not every else nodes, every)
    return best


def _searched(counts: dict[int, int], capacity: int, best: Packing, bound: int, nodes: int | None, every: bool) -> Packing:
    """The best packing found within ``nodes`` steps, through ``every`` filling or the most promising ones."""
    best_size = sum(t for t, _ in best)
    total = sum(n * k for n, k in counts.items())
    steps = 0

    # depth first, without recursion: (open fillings, undo, waste)
    left = dict(counts)
    lengths = sorted(left)
    path: Packing = []
    # of each level: its choices, if they are held, and how many were taken
    stack: list[list] = []
    waste = 0

    def sets(top: int) -> Iterator[tuple[int, ...]]:
        rest = {**left, top: left[top] - 1}
        if not every:
            yield from fillings(lengths, rest, capacity - top) or [()]
            return
        found = all_fillings(lengths, rest, capacity - top)
        while some := list(islice(found, 200)):
            yield from sorted(some, key=lambda chosen: (-sum(chosen), len(chosen)))

    def choices() -> Iterator[tuple[int, Filling, int]]:
        top = lengths[-1]
        for chosen in sets(top):
            room = capacity - top - sum(chosen)
            need = {top: 1}
            for n in chosen:
                need[n] = need.get(n, 0) + 1
            # sets end at `most` lengths; what still fits goes in by best fit
            at = bisect_right(lengths, room) - 1
            while at >= 0:
                n = lengths[at]
                more = min(room // n, left[n] - need.get(n, 0))
                if more > 0:
                    need[n] = need.get(n, 0) + more
                    room -= more * n
                at = min(at - 1, bisect_right(lengths, room) - 1)
            most = min(left[n] // k for n, k in need.items())
            filling = tuple(sorted(need.items(), reverse=True))
            for times in range(most, 0 if every else most - 1, -1):
                yield times, filling, room

    def change(times: int, filling: Filling, sign: int) -> None:
        for n, k in filling:
            before = left[n]
            left[n] = before - sign * times * k
            if left[n] == 0:
                lengths.remove(n)
            elif before == 0:
                insort(lengths, n)

    def descend(found: Iterator) -> None:
        stack.append([found, 0])
        if len(stack) > LIVE:
            stack[-LIVE - 1][0] = None

    used = 0
    descend(choices())
    while stack and best_size > bound and (nodes is None or steps < nodes):
        level = stack[-1]
        if level[0] is None:
            # counts are as they were, so the choices are too
            level[0] = islice(choices(), level[1], None)
        step = next(level[0], None)
        level[1] += 1
        steps += 1
        if step is None:
            stack.pop()
            if path:
                times, filling = path.pop()
                used -= times
                waste -= times * (capacity - sum(n * k for n, k in filling))
                change(times, filling, -1)
            continue
        times, filling, room = step
        # a packing of one sequence fewer than the best has this much waste to spend
        if waste + times * room > (best_size - 1) * capacity - total:
            continue
        change(times, filling, 1)
        path.append((times, filling))
        used += times
        waste += times * room
        if not lengths:
            if used < best_size:
                best, best_size = list(path), used
            descend(iter(()))
        else:
            descend(choices())
    return best


def _segments(packing: Packing) -> np.ndarray:
    """(length, first rank, first sequence, copies, offset) of each part of a filling, sorted."""
    rows, rank, base = [], {}, 0
    for times, filling in packing:
        offset = 0
        for length, copies in filling:
            rows.append((length, rank.get(length, 0), base, copies, offset))
            rank[length] = rank.get(length, 0) + times * copies
            offset += length * copies
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, nodes: int | None = 20_000) -> DataFrame:
    """Pack the documents of ``doc_id, text`` into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row
    per piece; see :func:`token_pieces`. Offsets in a sequence are gapless from 0.
    A null text is an empty document, repeated rows are packed each, null ids are
    passed through, other columns are left out and an empty table gives an empty
    result.
    """
    pieces = materialize(token_pieces(df, tokenizer, capacity, end_id), "pieces")
    total = pieces.count()
    # ranks are taken bucket by bucket, also within one frequent length
    buckets = max(16, total // 250_000)
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = spread.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))), "ranks")
    counts = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    table = _segments(complete(counts, capacity, nodes))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(starts, length << 48 | rank, "right") - 1
            _, first, base, copies, offset = table[at].T
            sequence, copy = np.divmod(rank - first, np.maximum(copies, 1))
            arrays = [batch.column(k) for k in range(5)]
            arrays += [pa.array(base + sequence), pa.array(offset + copy * length)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = spread.withColumn("_row", F.row_number().over(order)).join(before, ["length", "_bucket"])
    chosen = ranked.select(*names, (F.col("_row") - 1 + F.col("_before")).cast("long").alias("_rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return chosen.mapInArrow(place, schema)
