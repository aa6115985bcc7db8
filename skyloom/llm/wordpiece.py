"""Token counts by linear longest-match.

Greedy word-piece tokenisation takes, again and again, the longest piece that starts the rest of
a word.  Here a trie of the vocabulary carries, for every node, how many pieces greedy matching
would pop when no edge fits, and the node where matching then goes on (its failure link).  One
pass over a word's characters follows edges and links and adds up those counts, so no piece is
ever built and no character is matched again.

Word-starting pieces carry the vocabulary's mark of a word's start; the rest continue a word.  A
character that no piece has counts as its bytes, each a token (byte fallback).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, spread, take

MARK = "▁"
#: Distinct words whose counts a worker keeps.
CACHE = 400_000


class Automaton:
    """`step[node][character]` = (next node, pieces popped on the way); built once per vocabulary.

    `pieces` are the vocabulary's entries, word-starting ones with MARK in front.  Node 0 is where
    continuing pieces start, and `first` where a word does, behind its mark."""

    def __init__(self, pieces: list[str]):
        self.edges: list[dict[str, int]] = [{}]
        self.final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                node = self._child(node, c)
            self.final[node] = True
        n = len(self.edges)
        self.fail: list[int | None] = [None] * n
        self.pops = [0] * n
        queue = []
        for child in self.edges[0].values():
            # one character: popped whole if it is a piece; else nothing can be popped here
            if self.final[child]:
                self.fail[child], self.pops[child] = 0, 1
            queue.append(child)
        for node in queue:
            for c, child in self.edges[node].items():
                if self.final[child]:
                    self.fail[child], self.pops[child] = 0, 1
                else:
                    at, popped = self.fail[node], self.pops[node]
                    while at is not None and c not in self.edges[at]:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at is not None:
                        self.fail[child], self.pops[child] = self.edges[at][c], popped
                queue.append(child)
        self.first = self.edges[0].get(MARK, 0)

    def _child(self, node: int, c: str) -> int:
        child = self.edges[node].get(c)
        if child is None:
            child = self.edges[node][c] = len(self.edges)
            self.edges.append({})
            self.final.append(False)
        return child

    def count(self, word: str) -> int:
        """Greedy tokens of MARK + word."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node, total = self.first, 0
        for c in word:
            while True:
                nxt = edges[node].get(c)
                if nxt is not None:
                    node = nxt
                    break
                if node == 0:  # no piece has this character
                    total += len(c.encode())
                    break
                if fail[node] is None:
                    return self._slow(word)
                total += pops[node]
                node = fail[node]
        while node:
            if fail[node] is None:
                return self._slow(word)
            total += pops[node]
            node = fail[node]
        return total

    def _slow(self, word: str) -> int:
        """Where a piece's prefix has no piece of its own to fall back to, characters in it turn
        into bytes; such words are matched from their start."""
        text, at, total = (MARK if self.first else "") + word, 0, 0
        while at < len(text):
            node, end = 0, at
            for i in range(at, len(text)):
                node = self.edges[node].get(text[i])
                if node is None:
                    break
                if self.final[node]:
                    end = i + 1
            total += 1 if end > at else len(text[at].encode())
            at = max(end, at + 1)
        return total


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = (i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
    return Automaton([sp.id_to_piece(i) for i in kept])


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) of every whole text; words are runs of other than ASCII white space.

    Null and empty texts have none of either.  Repeated rows and null ids are counted like any
    other; an empty table gives no rows."""
    rows = spread(take(docs, id_col, text_col)).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()

    class Counts(dict):
        def __init__(self, auto: Automaton):
            super().__init__()
            self.auto = auto

        def __missing__(self, word: bytes) -> int:
            n = self.auto.count(word.decode())
            if len(word) < 64:
                if len(self) >= CACHE:
                    self.clear()
                self[word] = n
            return n

    def apply(batches):
        counts = Counts(automaton(path))
        for b in batches:
            n_words, n_tokens = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            text = b.column(1).cast(pa.binary())
            for i in range(len(b)):
                words = (text[i].as_py() or b"").split()
                n_words[i] = len(words)
                n_tokens[i] = sum(map(counts.__getitem__, words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words), pa.array(n_tokens)], names=["id", "n_words", "n_tokens"])

    return in_arrow(rows, apply, f"id {kind}, n_words long, n_tokens long")
