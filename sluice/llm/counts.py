"""Exact counts of 64-bit keys, gathered in packed blocks and merged by shard.

A task counts what it has read and sends one row per shard, holding sorted keys
and their counts as binary; a shard merges the rows of its keys. A hot key is one
entry per block, however many rows have it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

_packer = zstandard.ZstdCompressor(level=1)
_unpacker = zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Bytes of an integer array, planes of equal significance together, compressed."""
    wide = np.ascontiguousarray(values)
    planes = wide.view(np.uint8).reshape(len(wide), wide.itemsize).T
    return wide.dtype.str[1:].encode() + _packer.compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    kind = np.dtype("<" + blob[:2].decode())
    raw = np.frombuffer(_unpacker.decompress(blob[2:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Bytes of ascending integers, as differences."""
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    steps = unpack(blob)
    return np.cumsum(steps, dtype=steps.dtype)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    if len(keys) == 0:
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


def by_shard(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Ranges of ascending 64-bit keys with the same top bits."""
    if bits == 0:
        if len(keys):
            yield 0, slice(0, len(keys))
        return
    cuts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cuts = np.append(cuts, len(keys))
    for shard in range(1 << bits):
        if cuts[shard] < cuts[shard + 1]:
            yield shard, slice(cuts[shard], cuts[shard + 1])


def shard_bits(items: float, per_shard: int = 4_000_000) -> int:
    """Top bits that give shards of about ``per_shard`` items; no upper limit."""
    return max(0, int(np.ceil(np.log2(max(1.0, items / per_shard)))))
