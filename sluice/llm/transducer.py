"""Minimal acyclic transducers: sorted terms to their ordinals and back.

A transducer is an automaton that accepts exactly its terms and in which no two
states have the same continuations. Every state knows how many terms end in or
after it; the terms that a word passes on its way add up to its ordinal, its rank
among the terms in the order of their bytes. It is built in one pass over the
sorted terms: once a term leaves a branch, the branch's states are final and each
is replaced by an equal one if there is one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

from sluice.llm.counts import pack, unpack


@dataclass(frozen=True)
class Transducer:
    """Arcs in order of state and byte; state 0 is the start."""

    #: state << 8 | byte
    arcs: np.ndarray
    target: np.ndarray
    #: terms of the state that come before those of the arc
    before: np.ndarray
    final: np.ndarray
    terms: int

    def ordinals(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The ordinal of each word ``data[start:end]``, -1 if it is no term."""
        found = np.full(len(start), -1, np.int64)
        rows = np.arange(len(start))
        state, total, at = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), start.astype(np.int64)
        while len(rows):
            ended = at == end[rows]
            if ended.any():
                accepted = ended & self.final[state]
                found[rows[accepted]] = total[accepted]
                rows, state, total, at = (x[~ended] for x in (rows, state, total, at))
            if not len(self.arcs) or not len(rows):
                break
            key = state << 8 | data[at]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[arc] == key
            rows, arc = rows[hit], arc[hit]
            state, total, at = self.target[arc], total[hit] + self.before[arc], at[hit] + 1
        return found

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal."""
        if not 0 <= ordinal < self.terms:
            raise IndexError(ordinal)
        state, left, out = 0, ordinal, bytearray()
        while True:
            lo, hi = np.searchsorted(self.arcs, [state << 8, (state + 1) << 8])
            if left == 0 and self.final[state]:
                return bytes(out)
            arc = int(lo + np.searchsorted(self.before[lo:hi], left, "right") - 1)
            left -= int(self.before[arc])
            out.append(int(self.arcs[arc]) & 255)
            state = int(self.target[arc])

    def packed(self) -> list[bytes]:
        return [pack(self.arcs), pack(self.target), pack(self.before), np.packbits(self.final).tobytes()]

    @classmethod
    def unpacked(cls, parts: list[bytes], terms: int) -> Transducer:
        arcs, target, before = (unpack(p) for p in parts[:3])
        return cls(arcs, target, before, np.unpackbits(np.frombuffer(parts[3], np.uint8)).astype(bool), terms)


def build(terms: Iterable[bytes]) -> Transducer:
    """The transducer of distinct terms in the order of their bytes."""
    # finished states: (final, ((byte, state), ...)) -> number
    register: dict[tuple, int] = {}
    made: list[tuple] = []
    #: states on the path of the last term: [final, [(byte, state), ...]]
    path: list[list] = [[False, []]]
    last = b""
    count = 0

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            signature = (final, tuple(arcs))
            state = register.get(signature)
            if state is None:
                state = register[signature] = len(made)
                made.append(signature)
            path[-1][1].append((last[len(path) - 1], state))

    for term in terms:
        if count and term <= last:
            raise ValueError("terms must be distinct and in the order of their bytes")
        shared = 0
        while shared < min(len(term), len(last)) and term[shared] == last[shared]:
            shared += 1
        close(shared)
        path.extend([False, []] for _ in range(len(term) - shared))
        path[-1][0] = True
        last = term
        count += 1
    close(0)
    made.append((path[0][0], tuple(path[0][1])))

    # children come before their parents; numbered from the start state down
    size = np.zeros(len(made), np.int64)
    rows = []
    top = len(made) - 1
    for state, (final, arcs) in enumerate(made):
        total = int(final)
        for byte, target in arcs:
            rows.append(((top - state) << 8 | byte, top - target, total))
            total += int(size[target])
        size[state] = total
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    final = np.array([f for f, _ in reversed(made)], bool)
    return Transducer(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), final, count)
