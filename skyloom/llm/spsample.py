"""SentencePiece encoding by sampled segmentation, and decoding.

A text is cut into units: a run of spaces with the non-spaces behind it.  Pieces of the
vocabulary don't reach over units, so the lattice of a text is a chain of its units' lattices.
Forward filtering sums, for each place in a unit, the weights of all segmentations up to it;
backward sampling then draws the last piece, the one before it, and so on, each in proportion.
Draws come from a counter-based generator over (seed, row key, unit, draw), so a row's
segmentation depends on nothing but its key, its text and the seed.

The vocabulary's file ranks pieces; a piece's weight is (rank + 2) ** -alpha.  Characters that
are not pieces (and a literal mark of the space) become their bytes' pieces, so decoding gives
every text back.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, spread, take
from .trie import PieceTrie, codes

MARK = "▁"
UNIT = re.compile(r" +[^ ]*")
#: Longest unit that is handled with others of its length; longer ones are handled alone.
LONGEST = 32
CHUNK = 1 << 22


class Pieces:
    """The vocabulary: pieces with the space in place of its mark, and weights by number."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = sp.get_piece_size()
        self.number: dict[str, int] = {}
        self.bytes_: list[bytes] = [b""] * n
        self.byte_id = [0] * 256
        rank = np.full(n, float(n))
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_id[b], self.bytes_[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                text = piece.replace(MARK, " ")
                if " " in text.lstrip(" "):
                    raise ValueError(f"piece {piece!r} reaches over units")
                self.number[text] = i
                self.bytes_[i] = text.encode()
                if -sp.get_score(i) < n:
                    rank[i] = -sp.get_score(i)
        if not self.byte_id[0]:
            raise ValueError("the vocabulary has no pieces for bytes")
        for b in range(128):  # these are one byte's piece each
            self.number.setdefault(chr(b), self.byte_id[b])
        self.longest = max(map(len, self.number))
        self.trie = PieceTrie(self.number)
        self.weight = np.append((rank + 2.0) ** -alpha, [n**-alpha, 0.0])  # then: a character in bytes, no piece
        self.strange, self.none = n, n + 1
        self.chars = [max(1, len(x.decode(errors="ignore"))) for x in self.bytes_]


@lru_cache(maxsize=2)
def pieces(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: well-mixed bits of a counter."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(state: np.ndarray, step: int) -> np.ndarray:
    """Uniform numbers in [0, 1) of the given states at a step."""
    return (mix(state + np.uint64((0x9E3779B97F4A7C15 * (step + 1)) & (2**64 - 1))) >> np.uint64(11)) * 2.0**-53


def states(keys: np.ndarray, units: np.ndarray, seed: int) -> np.ndarray:
    """A state for each unit (its index in the row) of each row key."""
    with np.errstate(over="ignore"):
        return mix(mix(keys + np.uint64(seed)) ^ (units.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


@lru_cache(maxsize=64)
def _spans(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, end) by end j = 1..n, then by length 1..longest; starts below 0 are no spans."""
    return [(j - size, j) for j in range(1, n + 1) for size in range(1, longest + 1)]


def lattice(group: list[str], n: int, v: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """For units of n characters: piece numbers [unit, end - 1, length - 1], and for each end the
    running shares of the last piece's lengths among all segmentations up to that end."""
    size = min(v.longest, n)
    none = v.none
    spans = [(i, j) for i, j in _spans(n, size) if i >= 0]
    at = np.array([(j - 1) * size + (j - i - 1) for i, j in spans])
    ids = np.full((len(group), n * size), none, np.int32)
    v.trie.fill(codes(group, n), size, dict(zip(spans, at.tolist(), strict=True)), ids)
    ids = ids.reshape(len(group), n, size)
    ids[:, :, 0] = np.where(ids[:, :, 0] == none, v.strange, ids[:, :, 0])
    a = np.zeros((len(group), n + 1))
    a[:, 0] = 1
    share = np.zeros((len(group), n, size))
    for j in range(1, n + 1):
        top = min(size, j)
        w = a[:, j - top : j][:, ::-1] * v.weight[ids[:, j - 1, :top]]
        cum = np.cumsum(w, axis=1)
        a[:, j] = cum[:, -1]
        share[:, j - 1, :top] = cum / cum[:, -1:]
        # no draw may pass the last length that has weight
        last = top - 1 - (w[:, ::-1] > 0).argmax(1)
        share[np.arange(len(group))[:, None], j - 1, np.arange(size)[None]] = np.where(np.arange(size)[None] >= last[:, None], 2.0, share[:, j - 1])
    return ids, share


def sample(texts: list[str], keys: np.ndarray, v: Pieces, seed: int) -> list[np.ndarray]:
    """The piece numbers of each text."""
    number: dict[str, int] = {}
    occ: list[int] = []
    ends: list[int] = []
    for t in texts:
        occ += [number.setdefault(u, len(number)) for u in UNIT.findall(" " + t)] if t else []
        ends.append(len(occ))
    if not occ:
        return [np.zeros(0, np.int32)] * len(texts)
    word = np.array(occ)
    counts = np.diff([0, *ends])
    start = np.repeat(np.cumsum(counts) - counts, counts)
    unit = np.arange(len(word)) - start
    state = states(np.repeat(keys, counts), unit, seed)
    size = np.array([len(u) for u in number])
    groups: dict[int, list[str]] = {}
    for u in number:
        groups.setdefault(len(u) if len(u) <= LONGEST else -1, []).append(u)
    got_at, got_step, got_id = [], [], []
    of_len = size[word]
    slot = np.empty(len(number), np.int64)
    for n, group in groups.items():
        if n < 0:
            continue
        numbers = np.array([number[u] for u in group])
        slot[numbers] = np.arange(len(group))
        occs = np.flatnonzero(of_len == n)
        occs = occs[np.argsort(slot[word[occs]], kind="stable")]
        which = slot[word[occs]]
        for lo in range(0, len(group), 4096):
            ids, share = lattice(group[lo : lo + 4096], n, v)
            a, b = np.searchsorted(which, [lo, lo + 4096])
            live, row, pos, step = occs[a:b], which[a:b] - lo, np.full(b - a, n), 0
            while len(live):
                u = draws(state[live], step)
                back = (share[row, pos - 1] <= u[:, None]).sum(1)
                got_at.append(live)
                got_step.append(np.full(len(live), step, np.int32))
                got_id.append(ids[row, pos - 1, back])
                pos = pos - back - 1
                on = pos > 0
                live, row, pos, step = live[on], row[on], pos[on], step + 1
    if -1 in groups:
        unit_of = list(number)
        for at in np.flatnonzero(of_len > LONGEST):
            ids = _alone(unit_of[word[at]], state[at : at + 1], v)
            got_at.append(np.full(len(ids), at))
            got_step.append(np.arange(len(ids), dtype=np.int32))
            got_id.append(ids)
    at, step, ids = (np.concatenate(x) for x in (got_at, got_step, got_id))
    n_pieces = np.bincount(at, minlength=len(word))
    first = np.cumsum(n_pieces) - n_pieces
    out = np.empty(len(ids), np.int32)
    out[first[at] + n_pieces[at] - 1 - step] = ids
    edges = np.concatenate(([0], np.cumsum(n_pieces)))[np.array([0, *ends])]
    return [out[a:b] if not (out[a:b] == v.strange).any() else in_bytes(out[a:b], t, v) for a, b, t in zip(edges[:-1], edges[1:], texts, strict=True)]


def _edges(unit: str, v: Pieces) -> tuple[list[int], list[int], list[int]]:
    """The lattice of one long unit: lengths and piece numbers of all edges, by end and then by
    length, and where each end's edges begin."""
    n = len(unit)
    code = codes([unit], n)[0]
    live, node = np.arange(n), np.zeros(n, np.int32)
    ends, sizes, ids = [], [], []
    for size in range(1, v.longest + 1):
        inside = live + size <= n
        live, node = live[inside], node[inside]
        node = v.trie.step(node, code[live + size - 1])
        live, node = live[node >= 0], node[node >= 0]
        number = v.trie.number[node]
        ends.append(live[number >= 0] + size)
        ids.append(number[number >= 0])
        sizes.append(np.full(len(ends[-1]), size))
    odd = np.setdiff1d(np.arange(1, n + 1), ends[0])  # characters that are not pieces
    end, size, number = (np.concatenate(x) for x in ([*ends, odd], [*sizes, np.ones(len(odd), int)], [*ids, np.full(len(odd), v.strange)]))
    order = np.lexsort((size, end))
    begin = np.searchsorted(end[order], np.arange(n + 2))
    return size[order].tolist(), number[order].tolist(), begin.tolist()


def _alone(unit: str, state: np.ndarray, v: Pieces) -> np.ndarray:
    """The pieces of one long unit, last first; sums are kept as logarithms."""
    sizes, numbers, begin = _edges(unit, v)
    log_w = np.log(np.maximum(v.weight, 1e-300)).tolist()
    exp, log = math.exp, math.log
    total = [0.0] * (len(unit) + 1)
    for j in range(1, len(unit) + 1):
        xs = [total[j - sizes[k]] + log_w[numbers[k]] for k in range(begin[j], begin[j + 1])]
        peak = max(xs)
        total[j] = peak + log(sum([exp(x - peak) for x in xs])) if len(xs) > 1 else peak
    out, pos, uniform = [], len(unit), []
    while pos:
        if len(out) == len(uniform):  # as `draws`, many steps at once
            steps = np.arange(len(out) + 1, len(out) + 1025, dtype=np.uint64)
            uniform += ((mix(state + steps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53).tolist()
        ks = range(begin[pos], begin[pos + 1])
        cum = list(accumulate(exp(total[pos - sizes[k]] + log_w[numbers[k]] - total[pos]) for k in ks))
        k = ks[min(bisect_right(cum, uniform[len(out)] * cum[-1]), len(cum) - 1)]
        out.append(numbers[k])
        pos -= sizes[k]
    return np.array(out, np.int32)


def in_bytes(ids: np.ndarray, text: str, v: Pieces) -> np.ndarray:
    """Puts the pieces of a character's bytes for each stand-in, walking along the text."""
    out: list[int] = []
    pos, text = 0, " " + text
    for i in ids.tolist():
        if i == v.strange:
            out += [v.byte_id[b] for b in text[pos].encode()]
            pos += 1
        else:
            out.append(i)
            pos += v.chars[i]
    return np.array(out, np.int32)


def decode(ids: np.ndarray, v: Pieces) -> bytes:
    """The text (UTF-8) that the pieces came from: without the space in front."""
    names = v.bytes_
    return b"".join([names[i] for i in ids.tolist()])[1:]


def encode_sampled(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", alpha: float = 1.0, seed: int = 13) -> DataFrame:
    """(id, ids, n_pieces, ids_crc32, lossless): a sampled segmentation of each whole text, and
    whether decoding its ids gives the text back, byte by byte.

    Null and empty texts have no pieces.  Rows that share a key and a text are segmented alike;
    a null key is a key.  An empty table gives no rows.  Larger `alpha` favours frequent pieces."""
    rows = spread(take(docs, id_col, text_col)).toDF("id", "text").select("id", F.xxhash64("id").alias("key"), "text")
    kind = rows.schema["id"].dataType.simpleString()

    def apply(batches):
        v = pieces(path, alpha)
        for b in batches:
            keys = np.array(b.column(1)).view(np.uint64)
            lo = 0
            while lo < len(b):
                texts, size, hi = [], 0, lo
                while hi < len(b) and size < CHUNK:
                    texts.append(b.column(2)[hi].as_py() or "")
                    size += len(texts[-1])
                    hi += 1
                found = sample(texts, keys[lo:hi], v, seed)
                same = [decode(x, v) == t.encode() for x, t in zip(found, texts, strict=True)]
                n = np.array([len(x) for x in found])
                offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in found]
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), ids, pa.array(n), pa.array(crc, pa.int64()), pa.array(same)], names=["id", "ids", "n_pieces", "ids_crc32", "lossless"]
                )
                lo = hi

    return in_arrow(rows, apply, f"id {kind}, ids array<int>, n_pieces long, ids_crc32 long, lossless boolean")


def decode_table(encoded: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the texts that ids came from; null ids give a null text, unknown ids an error."""
    rows = take(encoded, id_col, ids_col).toDF("id", "ids")
    kind = rows.schema["id"].dataType.simpleString()

    def apply(batches):
        v = pieces(path, 1.0)
        for b in batches:
            texts = [None if x is None else decode(np.array(x, np.int32), v).decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return in_arrow(rows, apply, f"id {kind}, text string")
