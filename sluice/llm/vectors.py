"""Whole Arrow batches of text as numpy arrays: words, their hashes, runs of words.

The helpers work on the bytes of a slice of rows at once, so that a word costs a
few vector operations instead of a Python call. Slices are bounded by bytes; a
text longer than the bound is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C55)  # odd, so it has an inverse
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def let_go() -> None:
    """Give memory back that is free: Spark's workers live on, and keep what earlier tasks needed."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def tidy(work: Callable) -> Callable:
    """A task's function that gives free memory back when it begins and when it is done, as idle workers would keep it."""

    def through(given):  # noqa: ANN001, ANN202
        let_go()
        made = work(given)
        if isinstance(made, Iterator):
            return ended(made)
        let_go()
        return made

    def ended(made: Iterator) -> Iterator:
        yield from made
        let_go()

    return through


def _grown(powers: np.ndarray, base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        while len(powers) < n:
            step = powers[-1] * base
            powers = np.concatenate([powers, powers * step])
    return powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x = x * U64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U64(27))
        x = x * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the bytes times powers, and the inverse powers that move a sum to the origin."""
    global _powers, _inverses
    n = len(data) + 1
    if len(_powers) < n:
        _powers, _inverses = _grown(_powers, _BASE, n), _grown(_inverses, _INVERSE, n)
    sums = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(U64) + U64(1)) * _powers[: n - 1], out=sums[1:])
    return sums, _inverses[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges ``data[start:end]``."""
    sums, inverses = prefix_sums(data)
    with np.errstate(over="ignore"):
        return mixed((sums[end] - sums[start]) * inverses[start] + (end - start).astype(U64))


def rolling_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Cheaper hashes of all ranges of ``size`` bytes; high bits are good, low bits are not."""
    if len(data) < size:
        return np.zeros(0, U64)
    sums, inverses = prefix_sums(data)
    with np.errstate(over="ignore"):
        made = sums[size:] - sums[: len(sums) - size]
        made *= inverses[: len(made)]
        made *= U64(0xD1342543DE82EF95)
    return made


@dataclass
class Texts:
    """The bytes of some texts; text ``i`` is ``data[bounds[i]:bounds[i + 1]]``, empty if null."""

    data: np.ndarray
    bounds: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Texts:
        """A-Z as a-z; other bytes stay."""
        upper = (self.data >= 65) & (self.data <= 90)
        return Texts(self.data + (upper * np.uint8(32)), self.bounds, self.null)


@dataclass
class Words:
    """Words of some texts; those of text ``i`` are ``first[i]:first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def texts(column: pa.Array) -> Texts:
    """The texts of a string column, without copying their bytes."""
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, at, data = column.buffers()
    null = np.asarray(column.is_null(), dtype=bool)
    if at is None or len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64), null)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(raw, at - at[0], null)


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, each with at most ``limit`` bytes of text or one row."""
    bounds = texts(batch.column(batch.schema.get_field_index(name))).bounds
    row = 0
    while row < batch.num_rows:
        stop = int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop


def split_words(t: Texts) -> Words:
    r"""Words ``[^\x20\x09-\x0D]+`` of each text."""
    n = len(t.data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~((t.data == 32) | ((t.data >= 9) & (t.data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[t.bounds] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return Words(start, end, np.searchsorted(start, t.bounds))


def run_hashes(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``n`` consecutive items of each text, and where each text's runs begin."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    at = np.concatenate([[0], np.cumsum(counts)])
    begin = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], counts)
    with np.errstate(over="ignore"):
        made = np.full(len(begin), U64(n))
        for k in range(n):
            made = made * _BASE + hashes[begin + k]
    return mixed(made), at


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype != bool else np.int64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions ``start[i] .. start[i] + length[i]`` of all ranges, one after the other."""
    at = np.concatenate([[0], np.cumsum(length)])
    return np.arange(at[-1]) + np.repeat(start - at[:-1], length)
