"""A minimal acyclic transducer: a sorted set of byte words as one automaton that gives a word its
ordinal, and an ordinal its word.

States are merged as soon as no later word can change them, so memory holds the minimal automaton
and the path of the last word. An edge knows how many words sort before all words that take it; the
sum of these numbers along a word's path is its ordinal.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np


class _Open:
    """A state on the path of the last word, still growing."""

    __slots__ = ("final", "edges")

    def __init__(self) -> None:
        self.final = False
        self.edges: list[tuple[int, int]] = []


@dataclass
class Transducer:
    #: Edges sorted by state and label: state * 256 + label, where it goes, words before it.
    keys: np.ndarray
    targets: np.ndarray
    skips: np.ndarray
    final: np.ndarray
    root: int
    size: int
    depth: int

    @staticmethod
    def build(words: Iterable[bytes]) -> "Transducer":
        """From distinct words in ascending order."""
        known: dict[tuple, int] = {}
        below: list[int] = []
        shapes: list[tuple] = []

        def close(state: _Open) -> int:
            shape = (state.final, *state.edges)
            found = known.get(shape)
            if found is None:
                found = known[shape] = len(shapes)
                shapes.append(shape)
                below.append(state.final + sum(below[t] for _, t in state.edges))
            return found

        path, last, size, depth = [_Open()], b"", 0, 0

        def shorten(upto: int) -> None:
            while len(path) - 1 > upto:
                done = close(path.pop())
                path[-1].edges.append((last[len(path) - 1], done))

        for word in words:
            if size and word <= last:
                raise ValueError("words must be distinct and ascending")
            same = 0
            for x, y in zip(last, word):
                if x != y:
                    break
                same += 1
            shorten(same)
            path.extend(_Open() for _ in range(len(word) - same))
            path[-1].final = True
            last, size, depth = word, size + 1, max(depth, len(word))
        shorten(0)
        root = close(path[0])
        keys, targets, skips = [], [], []
        for i, (is_final, *edges) in enumerate(shapes):
            before = int(is_final)
            for label, target in edges:
                keys.append(i << 8 | label)
                targets.append(target)
                skips.append(before)
                before += below[target]
        return Transducer(
            np.asarray(keys, np.int64),
            np.asarray(targets, np.int32),
            np.asarray(skips, np.int32),
            np.asarray([s[0] for s in shapes], bool),
            root,
            size,
            depth,
        )

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """The place of every word among all, -1 for words that are not in here. All words take
        their next byte together."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not self.size:
            return out
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.fromiter(map(len, words), np.int64, n)
        start = np.cumsum(length) - length
        alive = np.flatnonzero(length <= self.depth)
        state, at = np.full(len(alive), self.root, np.int64), np.zeros(len(alive), np.int64)
        for step in range(self.depth + 1):
            ends = length[alive] == step
            hit = ends & self.final[state]
            out[alive[hit]] = at[hit]
            alive, state, at = alive[~ends], state[~ends], at[~ends]
            if not len(alive):
                break
            want = state << 8 | data[start[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            there = self.keys[edge] == want
            alive, edge = alive[there], edge[there]
            state, at = self.targets[edge].astype(np.int64), at[there] + self.skips[edge]
        return out

    def word(self, ordinal: int) -> bytes:
        """The word at a place."""
        out, state = bytearray(), self.root
        while not (self.final[state] and ordinal == 0):
            first, end = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            edge = first + int(np.searchsorted(self.skips[first:end], ordinal, "right")) - 1
            out.append(int(self.keys[edge]) & 255)
            ordinal -= int(self.skips[edge])
            state = int(self.targets[edge])
        return bytes(out)

    def to_bytes(self) -> bytes:
        head = np.asarray([len(self.keys), len(self.final), self.root, self.size, self.depth], "<i8")
        parts = (head, self.keys.astype("<i8"), self.targets.astype("<i4"), self.skips.astype("<i4"), self.final)
        return b"".join(p.tobytes() for p in parts)

    @staticmethod
    def from_bytes(data: bytes) -> "Transducer":
        edges, states, root, size, depth = np.frombuffer(data, "<i8", 5).tolist()
        at, found = 40, []
        for kind, n in (("<i8", edges), ("<i4", edges), ("<i4", edges), ("?", states)):
            found.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return Transducer(*found, root, size, depth)
