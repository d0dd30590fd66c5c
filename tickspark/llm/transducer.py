"""Finite-state machinery, vectorised over many words or chunks at a time.

``compile_transducer`` builds the minimal acyclic transducer of a sorted word list: equal suffixes
share states, and the number that belongs to a word is the sum of the outputs on its path.
``Table`` is its memory-mapped form. ``ChunkedMachine`` runs a small deterministic transducer over
a long sequence: every chunk yields a map from start state to end state, an inclusive prefix scan
composes the maps, and a second pass emits with the true start states.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np

_OUT_BITS = 24


@dataclass(frozen=True)
class Transducer:
    """Arcs sorted by source state; state numbers are such that arcs lead to smaller numbers."""

    source: np.ndarray
    label: np.ndarray
    target: np.ndarray
    output: np.ndarray
    final: np.ndarray  # output on ending in a state, -1 where no word ends
    root: int
    root_output: int
    longest: int


def compile_transducer(items: Iterable[tuple[bytes, int]]) -> Transducer:
    """Minimal transducer from (word, number >= 0) pairs in byte order, words distinct."""
    registry: dict[tuple, int] = {}
    rows: list[tuple] = []
    path: list[list] = [[-1, []]]  # of the last word: [final output, arcs]
    last, longest = b"", 0

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            number, least = register(path.pop())
            path[-1][1].append((last[len(path) - 1], least, number))

    def register(node: list) -> tuple[int, int]:
        final, arcs = node
        least = min([a[1] for a in arcs] + ([final] if final >= 0 else []), default=0)
        key = (final - least if final >= 0 else -1, tuple((b, o - least, t) for b, o, t in arcs))
        if (number := registry.get(key)) is None:
            number = registry[key] = len(rows)
            rows.append(key)
        return number, least

    for word, value in items:
        same = 0
        for a, b in zip(last, word, strict=False):
            if a != b:
                break
            same += 1
        freeze(same)
        path.extend([-1, []] for _ in range(len(word) - same))
        path[-1][0] = value
        last, longest = word, max(longest, len(word))
    freeze(0)
    root, root_output = register(path[0])
    arcs = [(s, b, t, o) for s, (_, out) in enumerate(rows) for b, o, t in out]
    source, label, target, output = (np.array(x, np.int32) for x in (zip(*arcs, strict=True) if arcs else ((), (), (), ())))
    return Transducer(source, label, target, output, np.array([r[0] for r in rows], np.int32), root, root_output, longest)


class Table:
    """A transducer as one table of (next state, output), in a memory-mapped file without a name.

    Bytes that no word has share the column 0. One more state, from which nothing leads back,
    stands for "not in the list"."""

    def __init__(self, t: Transducer):
        used = np.unique(t.label)
        self.columns = len(used) + 1
        self.classes = np.zeros(256, np.int32)
        self.classes[used] = np.arange(1, self.columns)
        n = len(t.final)
        self.dead = n * self.columns
        cells = (n + 1) * self.columns
        file = tempfile.TemporaryFile()  # noqa: SIM115  lives as long as the map
        file.truncate(cells * 8)
        self.cells = np.memmap(file, np.int64, "r+", shape=(cells,))
        self.cells[:] = self.dead << _OUT_BITS
        self.cells[t.source.astype(np.int64) * self.columns + self.classes[t.label]] = (t.target.astype(np.int64) * self.columns << _OUT_BITS) | t.output
        self.final = np.full(n + 1, -1, np.int32)
        self.final[:n] = t.final
        self.root, self.root_output, self.longest = t.root * self.columns, t.root_output, t.longest

    def look_up(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The number of each word data[start : start + length], -1 for words not in the list."""
        n = len(start)
        if not n or not self.longest:
            return np.full(n, -1, np.int64)
        short = np.minimum(length, self.longest + 1)
        order = np.argsort(short.astype(np.uint16), kind="stable")[::-1]
        at, many = start[order], np.bincount(short, minlength=self.longest + 2)
        longer = n - np.cumsum(many)  # words of more than k bytes stand first
        column = self.classes[data]
        state, total = np.full(n, self.root, np.int64), np.full(n, self.root_output, np.int64)
        for k in range(self.longest):
            m = int(longer[k])
            if not m:
                break
            cell = self.cells[state[:m] + column[at[:m] + k]]
            total[:m] += cell & ((1 << _OUT_BITS) - 1)
            state[:m] = cell >> _OUT_BITS
        state[: int(longer[self.longest])] = self.dead
        end = self.final[state // self.columns]
        out = np.empty(n, np.int64)
        out[order] = np.where(end < 0, -1, total + end)
        return out


class ChunkedMachine:
    """A deterministic transducer of at most 16 states over at most 16 symbols."""

    def __init__(self, states: int, symbols: int, step: Callable[[int, int], tuple[int, int]], chunk: int = 256):
        self.states, self.chunk = states, chunk
        follow, emit = bytearray(256), bytearray(256)
        for q in range(states):
            for c in range(symbols):
                follow[q << 4 | c], emit[q << 4 | c] = step(q, c)
        self._follow, self._emit = bytes(follow), bytes(emit)

    @staticmethod
    def _through(table: bytes, index: np.ndarray) -> np.ndarray:
        return np.frombuffer(index.tobytes().translate(table), np.uint8).reshape(index.shape)

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """What each step emits, from state 0."""
        n, size = len(symbols), self.chunk
        chunks = max(1, -(-n // size))
        padded = np.zeros(chunks * size, np.uint8)
        padded[:n] = symbols
        steps = np.ascontiguousarray(padded.reshape(chunks, size).T)
        maps = np.repeat(np.arange(self.states, dtype=np.uint8)[:, None], chunks, 1)
        for s in steps:
            maps = self._through(self._follow, maps << 4 | s)
        reach = 1
        while reach < chunks:  # maps[:, i] becomes the map over all chunks up to i
            maps = np.concatenate([maps[:, :reach], np.take_along_axis(maps[:, reach:], maps[:, :-reach], 0)], 1)
            reach *= 2
        state = np.concatenate([np.zeros(1, np.uint8), maps[0, :-1]])
        out = np.empty((size, chunks), np.uint8)
        for k, s in enumerate(steps):
            index = state << 4 | s
            out[k] = self._through(self._emit, index)
            state = self._through(self._follow, index)
        return np.ascontiguousarray(out.T).reshape(-1)[:n]
