"""A trie of pieces whose edges are looked up for many words at once."""

from __future__ import annotations

import numpy as np


def codes(words: list[str], n: int) -> np.ndarray:
    """The code points of words of n characters each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).astype(np.int64)


class PieceTrie:
    """Edges lie in an open-addressing hash table of arrays; `number` has each node's piece or -1."""

    def __init__(self, pieces: dict[str, int]):
        edges: dict[int, int] = {}
        number = [-1]
        for piece, k in pieces.items():
            node = 0
            for c in piece:
                key = node << 21 | ord(c)
                nxt = edges.get(key)
                if nxt is None:
                    nxt = edges[key] = len(number)
                    number.append(-1)
                node = nxt
            number[node] = k
        self.number = np.array(number, np.int32)
        bits = max(4, (4 * len(edges)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.child = np.full(1 << bits, -1, np.int32)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        for key, slot, to in zip(keys.tolist(), self._slots(keys).tolist(), edges.values(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.child[slot] = key, to

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Each node's child by its character, or -1."""
        key = nodes.astype(np.int64) << 21 | chars
        slot = self._slots(key)
        found = self.keys[slot]
        out = np.where(found == key, self.child[slot], -1)
        again = np.flatnonzero((found != key) & (found >= 0))
        while len(again):
            slot[again] = (slot[again] + 1) & self.mask
            found = self.keys[slot[again]]
            hit = found == key[again]
            out[again[hit]] = self.child[slot[again[hit]]]
            again = again[~hit & (found >= 0)]
        return out

    def fill(self, words: np.ndarray, longest: int, column: dict[tuple[int, int], int], out: np.ndarray) -> None:
        """Writes the number of every piece at (start, end) of every word into out[word, column]."""
        n = words.shape[1]
        for i in range(n):
            live, node = np.arange(len(words)), np.zeros(len(words), np.int32)
            for j in range(i, min(n, i + longest)):
                node = self.step(node, words[live, j])
                on = node >= 0
                live, node = live[on], node[on]
                if not len(live):
                    break
                number = self.number[node]
                is_piece = number >= 0
                out[live[is_piece], column[i, j + 1]] = number[is_piece]
