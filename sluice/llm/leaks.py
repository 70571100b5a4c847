"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a document with up to ``e`` edits. Cut into ``e + 1``
pieces, at least one piece then occurs unchanged. Pieces are looked up at every
position of every text by a rolling hash; around each hit the whole item is
matched with Myers' bit-parallel edit distance, many hits at once.

The items are the query set: they go to the tasks in blocks of bounded size, and
documents are read once per block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.vectors import U64, Texts, ragged, rolling_hashes, slices, span_hashes, texts

ERROR_RATE = 0.08
BLOCK_BYTES = 1 << 20
ALL = U64(2**64 - 1)


def normal(t: Texts) -> tuple[Texts, np.ndarray]:
    """Lower case A-Z, one space for white space, none at the ends; and where each byte was."""
    low = t.lowered()
    space = (low.data == 32) | ((low.data >= 9) & (low.data <= 13))
    data = np.where(space, np.uint8(32), low.data)
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    # white space at a text's beginning or end; a text's first byte has no byte before it
    first = t.bounds[:-1][np.diff(t.bounds) > 0]
    keep[first] = ~space[first]
    at = np.flatnonzero(keep)
    bounds = np.searchsorted(at, t.bounds)
    tail = bounds[1:][np.diff(bounds) > 0] - 1
    blank = tail[data[at[tail]] == 32]
    at = np.delete(at, blank)
    return Texts(data[at], np.searchsorted(at, t.bounds), t.null), at


@dataclass
class Items:
    """A block of test items, ready to be looked for."""

    ids: list
    texts: list[np.ndarray]
    rate: float
    errors: np.ndarray = field(init=False)
    #: by length of the looked-up part: its hashes in order, and the piece each belongs to
    anchors: dict[int, tuple[np.ndarray, np.ndarray]] = field(init=False)
    piece: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        length = self.length = np.array([len(x) for x in self.texts], np.int64)
        self.errors = np.floor(length * self.rate).astype(np.int64)
        pieces = []
        for k, (n, e) in enumerate(zip(length, self.errors, strict=True)):
            cuts = np.arange(e + 2) * n // (e + 1)
            pieces += [(k, a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.piece = np.array(pieces, np.int64).reshape(-1, 3)
        data = np.concatenate([np.zeros(0, np.uint8), *self.texts])
        base = np.concatenate([[0], np.cumsum(length)])
        start = base[self.piece[:, 0]] + self.piece[:, 1]
        self.whole = span_hashes(data, start, start + self.piece[:, 2])
        self.anchors = {}
        # the largest power of two that fits a piece
        q = 1 << np.maximum(0, np.floor(np.log2(np.maximum(self.piece[:, 2], 1)))).astype(np.int64)
        for size in np.unique(q):
            mine = np.flatnonzero(q == size)
            h = rolling_hashes(data, int(size))[start[mine]]
            order = np.argsort(h)
            self.anchors[int(size)] = (h[order], mine[order])

    def hits(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(position, piece) of every unchanged piece."""
        where, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        owner_end = np.repeat(t.bounds[1:], np.diff(t.bounds))
        for size, (known, pieces) in self.anchors.items():
            n = len(t.data) - size + 1
            if n <= 0:
                continue
            raw = rolling_hashes(t.data, size)
            table = np.zeros(1 << 18, bool)
            table[(known >> U64(46)).astype(np.int64)] = True
            some = np.flatnonzero(table[(raw >> U64(46)).astype(np.int64)])
            lo, hi = np.searchsorted(known, raw[some], "left"), np.searchsorted(known, raw[some], "right")
            some, lo, hi = some[hi > lo], lo[hi > lo], hi[hi > lo]
            at = np.repeat(some, hi - lo)
            piece = pieces[ragged(lo, hi - lo)]
            end = at + self.piece[piece, 2]
            inside = end <= owner_end[at]
            at, piece, end = at[inside], piece[inside], end[inside]
            if len(at):
                same = span_hashes(t.data, at, end) == self.whole[piece]
                where.append(at[same])
                which.append(piece[same])
        return np.concatenate(where), np.concatenate(which)


def best_match(patterns: list[np.ndarray], which: np.ndarray, windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of a pattern to any part of its window, and where that part ends.

    Myers' bit vectors in blocks of 64 rows, all windows side by side; of equal
    distances the earliest end counts.
    """
    m = np.array([len(p) for p in patterns], np.int64)
    blocks = int(-(-m.max() // 64))
    table = np.zeros((len(patterns), blocks, 256), U64)
    for k, p in enumerate(patterns):
        at = np.arange(len(p))
        np.bitwise_or.at(table[k], (at // 64, p), U64(1) << (at % 64).astype(U64))
    n = len(windows)
    size = np.array([len(w) for w in windows], np.int64)
    text = np.zeros((int(size.max(initial=0)), n), np.uint8)
    for k, w in enumerate(windows):
        text[: len(w), k] = w
    plus, minus = np.full((blocks, n), ALL), np.zeros((blocks, n), U64)
    last, bit = (m[which] - 1) // 64, ((m[which] - 1) % 64).astype(U64)
    score = m[which].copy()
    best, end = score.copy(), np.zeros(n, np.int64)
    one, top = U64(1), U64(63)
    with np.errstate(over="ignore"):
        for j in range(len(text)):
            up, down = np.zeros(n, U64), np.zeros(n, U64)
            for b in range(blocks):
                eq = table[which, b, text[j]]
                pv, mv = plus[b], minus[b]
                xv = eq | mv
                eq = eq | down
                xh = (((eq & pv) + pv) ^ pv) | eq
                ph = mv | ~(xh | pv)
                mh = pv & xh
                at = last == b
                if at.any():
                    score += np.where(at, ((ph >> bit) & one).astype(np.int64) - ((mh >> bit) & one).astype(np.int64), 0)
                next_up, next_down = ph >> top, mh >> top
                ph, mh = (ph << one) | up, (mh << one) | down
                plus[b], minus[b] = mh | ~(xv | ph), ph & xv
                up, down = next_up, next_down
            better = (score < best) & (j < size)
            best, end = np.where(better, score, best), np.where(better, j + 1, end)
    return best, end


Found = tuple[int, int, int, int, int]


def matches(batch: pa.RecordBatch, column: int, items: Items, group: int = 4000) -> list[Found]:
    """(row, item, distance, begin, end) of each item found, at its best place; places in bytes.

    Candidates of all slices of the batch are verified together.
    """
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    held: list[tuple] = []
    row = 0

    def keep(r: int, i: int, d: int, lo: int, hi: int) -> None:
        if (d, lo) < out.get((r, i), (d + 1, 0))[:2]:
            out[r, i] = (d, lo, hi)

    for part in slices(batch, batch.schema.names[column]):
        raw = texts(part.column(column))
        t, origin = normal(raw)
        for r, i, lo, hi in _candidates(t, items):
            where = origin[lo:hi] - raw.bounds[r]
            held.append((row + r, i, t.data[lo:hi], where))
        row += part.num_rows
    # items of a similar size together
    size = {i: -(-len(items.texts[i]) // 64) for i in {c[1] for c in held}}
    held.sort(key=lambda c: size[c[1]])
    for k in range(0, len(held), group):
        for r, i, d, lo, hi in _verify(held[k : k + group], items):
            keep(r, i, d, lo, hi)
    return [(r, i, *found) for (r, i), found in sorted(out.items())]


def _candidates(t: Texts, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, begin, end) of windows that may hold an item."""
    at, piece = items.hits(t)
    if len(at) == 0:
        return
    item, offset, _ = items.piece[piece].T
    row = np.searchsorted(t.bounds, at, "right") - 1
    # hits on nearby diagonals are one candidate
    line = (at - offset) // (items.errors[item] + 1)
    row, item, line = np.unique(np.stack([row, item, line], axis=1), axis=0).T
    e, length = items.errors[item], items.length[item]
    lo = np.maximum(line * (e + 1) - e, t.bounds[row])
    hi = np.minimum(line * (e + 1) + 2 * e + length, t.bounds[row + 1])
    # no match can be this short
    fits = hi - lo >= length - e
    yield from zip(row[fits].tolist(), item[fits].tolist(), lo[fits].tolist(), hi[fits].tolist(), strict=True)


def _verify(held: list[tuple], items: Items) -> Iterator[Found]:
    rest = []
    for r, i, window, where in held:
        # most leaks are word for word
        at = window.tobytes().find(items.texts[i].tobytes())
        if at >= 0:
            yield r, i, 0, int(where[at]), int(where[at + len(items.texts[i]) - 1]) + 1
        else:
            rest.append((r, i, window, where))
    if not rest:
        return
    names, which = np.unique([c[1] for c in rest], return_inverse=True)
    patterns = [items.texts[i] for i in names]
    best, end = best_match(patterns, which, [c[2] for c in rest])
    good = np.flatnonzero(best <= items.errors[names[which]])
    if len(good) == 0:
        return
    # backwards from the end for the beginning of the same match
    back = [rest[k][2][: end[k]][::-1] for k in good]
    _, reach = best_match([p[::-1] for p in patterns], which[good], back)
    for k, n in zip(good, reach, strict=True):
        r, i, _, where = rest[k]
        yield r, i, int(best[k]), int(where[end[k] - n]), int(where[end[k] - 1]) + 1


def item_blocks(items: DataFrame, rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """Blocks of test items of about ``block_bytes``; items without text are left out."""
    ids, held, size = [], [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").toLocalIterator():
        made = normal(texts(pa.array([row["text"]], pa.string())))[0].data
        if len(made) == 0:
            continue
        ids.append(row["item_id"])
        held.append(made)
        size += len(made)
        if size >= block_bytes:
            yield Items(ids, held, rate)
            ids, held, size = [], [], 0
    if ids:
        yield Items(ids, held, rate)


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Where test items occur in documents: ``doc_id, item_id, distance, begin, end``.

    One row per document row and item, for the place with the fewest edits (the
    earliest of equals); ``begin`` and ``end`` are byte offsets into the UTF-8
    text. Letters A-Z match in either case and white space matches white space;
    edits are counted in bytes of what is left, up to ``rate`` of the item's
    length. Null and empty texts match nothing, null ids are passed through,
    repeated rows are found each, and empty tables give an empty result.
    """

    def search(block: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                found = matches(whole, 1, block)
                ids = whole.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                arrays = [ids, pa.array([block.ids[f[1]] for f in found], pa.int64())]
                arrays += [pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "distance", "begin", "end"])

        return rows

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance long, begin long, end long"
    parts = [chosen.mapInArrow(search(b), schema) for b in item_blocks(items, rate, block_bytes)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no test item occurs, with all their columns."""
    place = docs.columns.index("text")

    def clean(block: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                bad = {f[0] for f in matches(whole, place, block)}
                yield whole.filter(pa.array([k not in bad for k in range(whole.num_rows)], pa.bool_()))

        return rows

    out = docs
    for block in item_blocks(items, rate, block_bytes):
        out = out.mapInArrow(clean(block), docs.schema)
    return out
