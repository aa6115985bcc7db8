"""Packing along a space-filling curve.

Every document becomes its token ids and an end id.  Hashed token counts, projected to a few
dimensions at random, place it in space; its Hilbert key orders documents so that neighbours are
alike.  A range sort by that key deals the documents out evenly (the id breaks ties, so copies
spread), and each range packs its documents one after another, cutting at `length` tokens.  What
is left at a range's end fills sequences of falling powers of two, which need no padding.

Ids are those of the tokenizers library with its defaults: strings of the file's added tokens are
those tokens.  A second encoder gives the same ids several times faster; it fails on very long runs
of white space, so texts that hold such a run go to the library itself.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialise, spread, take

DIMS, HASHED, ORDER = 4, 256, 15
#: Bytes of text tokenised at once in a worker.
CHUNK = 1 << 21
#: Bytes of ids in a range of the curve, about.
RANGE_BYTES = 256 << 20
#: A run of white space (as patterns take it) that the faster encoder is not given: its matcher's
#: stack grows with the run, and overflows at some hundred thousand characters.
LONG_RUN = re.compile(r"(?<!\s)\s{20000}")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """The ids of a byte-level BPE file of the tokenizers library, as that library gives them."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", [])
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that match by their surroundings are not supported")
        special = {t["content"]: t["id"] for t in added}
        byte = _byte_of()
        # ids of merged pieces are their merge ranks
        ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self.fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.size = self.fast.n_vocab
        self._slow = None

    @property
    def slow(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow

    def __call__(self, text: str) -> list[int]:
        if LONG_RUN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def projection(seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.standard_normal((HASHED, DIMS)) / np.sqrt(HASHED)


def hilbert(cells: np.ndarray, bits: int = ORDER) -> np.ndarray:
    """Hilbert keys of the rows of `cells` (whole numbers below 2**bits): axes are turned into the
    transposed index by Gray-code exchanges from the highest bit down, and its bits are interleaved."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t = np.where(x[n - 1] & (1 << b), t ^ ((1 << b) - 1), t)
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(flat: np.ndarray, sizes: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """The Hilbert key of each document's hashed, projected token counts."""
    m = len(sizes)
    h = flat.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (h >> np.uint64(56)).astype(np.int64) % HASHED
    sign = np.where(h & np.uint64(1 << 40), 1.0, -1.0)
    doc = np.repeat(np.arange(m), sizes)
    counts = np.bincount(doc * HASHED + bucket, weights=sign, minlength=m * HASHED).reshape(m, HASHED)
    counts = np.sign(counts) * np.sqrt(np.abs(counts))
    norm = np.sqrt((counts**2).sum(1, keepdims=True))
    place = counts @ proj / np.maximum(norm, 1e-12) * np.sqrt(HASHED)
    unit = 1 / (1 + np.exp(-1.7 * place))  # about the normal's distribution function, so cells fill evenly
    return hilbert(np.minimum((unit * (1 << ORDER)).astype(np.int64), (1 << ORDER) - 1))


def tokenised(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """(id, key, n, ids): ids as little-endian unsigned numbers of two or four bytes."""
    rows = spread(take(docs, id_col, text_col)).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    proj = projection()

    def apply(batches):
        encode = encoder(tokenizer)
        dtype = np.dtype("<u2" if max(encode.size, end_id + 1) <= 1 << 16 else "<u4")
        for b in batches:
            text, sizes = b.column(1), b.column(1).cast(pa.binary()).to_pandas().map(lambda x: len(x or b"")).to_numpy()
            lo = 0
            while lo < len(b):
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), CHUNK, "right")) + lo)
                each = [np.array(encode(t or "") + [end_id], dtype) for t in text.slice(lo, hi - lo).to_pylist()]
                n = np.array([len(x) for x in each])
                keys = curve_keys(np.concatenate(each), n, proj)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(keys), pa.array(n), pa.array([x.tobytes() for x in each], pa.binary())], names=["id", "key", "n", "ids"]
                )
                lo = hi

    return in_arrow(rows, apply, f"id {kind}, key long, n long, ids binary")


def packed_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str, end_id: int = 0, length: int = 1024) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (little-endian
    unsigned numbers of `width` bytes) and ids_crc32 (of the ids at four bytes each).

    Every token of every document lies in exactly one piece.  A null or empty text is its end id
    alone; rows with null or repeated ids are packed like any other; an empty table gives no rows.
    Sequences hold `length` tokens, a power of two, or a smaller power of two at a range's end."""
    if length & (length - 1):
        raise ValueError("length is a power of two")
    spark = docs.sparkSession
    ids = materialise(tokenised(docs, id_col, text_col, tokenizer, end_id), "tokens")
    size = 2 * (ids.agg(F.sum("n")).first()[0] or 0)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # the last two keys only order rows that share an id, so that a task run again packs alike
    order = ["key", "id", "n", F.xxhash64("ids")]
    ranged = ids.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    kind = ids.schema["id"].dataType.simpleString()

    def pack(batches):
        seq, room = 0, length  # of the sequence being filled
        held: list[list] = []  # pieces of the sequence being filled
        part = 0

        def emit(rows: list[list]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            types = [id_type, *[pa.int64()] * 6, pa.binary(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32", "ids", "width"])

        def row(doc, start, raw, total, seq, offset, width):
            wide = raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()
            return [doc, start, len(raw) // width, total, (part << 40) + seq, offset, zlib.crc32(wide), raw, width]

        id_type = pa.int64()
        for b in batches:
            id_type = b.schema.field(0).type
            out, size = [], 0
            for doc, total, raw, part in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):  # noqa: B007
                width, start = len(raw) // total, 0
                while start < total:
                    k = min(room, total - start)
                    held.append([doc, start, raw[start * width : (start + k) * width], total, width])
                    start, room = start + k, room - k
                    if not room:
                        offset = 0
                        for d, s, r, t, w in held:
                            out.append(row(d, s, r, t, seq, offset, w))
                            offset += len(r) // w
                        size += length * width
                        held, seq, room = [], seq + 1, length
                        if size >= CHUNK:
                            yield emit(out)
                            out, size = [], 0
            if out:
                yield emit(out)
        out, rest = [], length - room
        offset = 0
        for d, s, r, t, w in held:
            while r:
                top = 1 << (rest.bit_length() - 1)  # the sequence's length
                k = min(top - offset, len(r) // w)
                out.append(row(d, s, r[: k * w], t, seq, offset, w))
                s, r, offset = s + k, r[k * w :], offset + k
                if offset == top:
                    seq, rest, offset = seq + 1, rest - top, 0
        if out:
            yield emit(out)

    return in_arrow(ranged, pack, f"id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long, ids binary, width int")
