"""SimHash near-duplicate groups by pigeonhole blocks.

A document's 64-bit fingerprint takes the majority bit of the XXH64 hashes of its word
shingles.  Fingerprints that differ in at most `max_bits` bits are linked.  Cutting the 64
bits into `max_bits + 2` blocks leaves any linked pair with two equal blocks, so joining on
pairs of blocks finds every link; Hamming distance then verifies it.  Documents with equal
fingerprints collapse first, so a group of copies costs one fingerprint however large it is.

A block bucket holds distinct fingerprints only.  Buckets of up to `bucket_cap` are verified
pairwise and give the edges of a spanning forest.  Larger ones take an exact detour: two
fingerprints differ in at most two bits exactly if flipping at most one bit in each can make
them equal, and each such meeting point has at most 65 fingerprints.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, materialise, rows_of, spread, take, with_row

BITS = 64
#: Bytes of text that are shingled at once in a worker.
CHUNK = 1 << 20


def shingle_hashes(words: list[bytes], width: int, seed: int = 42) -> list[int]:
    """XXH64 of every run of `width` words, joined by single spaces; of all words if fewer."""
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(b" ".join(words), seed)]
    rows = [words[i : len(words) - width + 1 + i] for i in range(width)]
    join = b" ".join
    return [digest(join(s), seed) for s in zip(*rows, strict=True)]


def fingerprints(texts: list[bytes | None], width: int) -> np.ndarray:
    """A fingerprint for each text (UTF-8, null counts as empty); 0 if it has no word."""
    out = np.zeros(len(texts), np.uint64)
    at, hashes, ends, size = [], [], [], 0

    def flush() -> None:
        nonlocal at, hashes, ends, size
        if at:
            h = np.array(hashes, np.uint64)
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
            n = np.diff(np.concatenate((starts, [len(h)])))
            major = (2 * counts > n[:, None]).astype(np.uint8)
            out[at] = np.packbits(major, axis=1, bitorder="little").view(np.uint64)[:, 0]
        at, hashes, ends, size = [], [], [], 0

    for i, text in enumerate(texts):
        if not text:
            continue
        if len(text) > 4 * CHUNK:
            out[i] = _long_fingerprint(text, width)
            continue
        found = shingle_hashes(text.lower().split(), width)
        if found:
            at.append(i)
            hashes += found
            ends.append(len(hashes))
            size += len(text)
            if size >= CHUNK:
                flush()
    flush()
    return out


def _long_fingerprint(text: bytes, width: int) -> int:
    """As `fingerprints`, for one very long text, in bounded extra memory."""
    words = text.lower().split()
    counts, n = np.zeros(BITS, np.int64), 0
    step = 1 << 17
    for lo in range(0, max(1, len(words) - width + 1), step):
        h = np.array(shingle_hashes(words[lo : lo + step + width - 1], width), np.uint64)
        if len(h):
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(h)
    major = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(major, bitorder="little").view(np.uint64)[0])


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row per document: the id, `th` (a hash of the text) and `fp`, the fingerprint as a
    signed long.  Null, empty and wordless texts have fingerprint 0."""
    rows = spread(take(docs, id_col, text_col)).toDF("id", "text")
    rows = rows.select("id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))

    def apply(batches):
        for b in batches:
            text = b.column(2)
            fp = np.zeros(len(text), np.uint64)
            for lo in range(0, len(text), 256):
                fp[lo : lo + 256] = fingerprints(text.slice(lo, 256).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=["id", "th", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, apply, f"id {kind}, th long, fp long")


def _blocks(max_bits: int) -> list[int]:
    """Bit masks of the blocks' pairs, as signed longs."""
    n = max_bits + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    masks = [sum(1 << b for b in range(cuts[i], cuts[i + 1])) for i in range(n)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(masks[a] | masks[b]) for a, b in combinations(range(n), 2)]


def spanning_edges(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    v = fps.view(np.uint64)
    n = len(v)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges = []
    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= max_bits)
        for j in (near + i + 1).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((int(fps[i]), int(fps[j])))
    return edges


def links(distinct: DataFrame, max_bits: int = 2, bucket_cap: int = 2048) -> DataFrame:
    """Edges (a, b) that connect just the fingerprints linked by chains of links.

    `distinct` has distinct longs in `fp`.  `max_bits` is 1 or 2."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits is 1 or 2")
    masks = _blocks(max_bits)
    keyed = distinct.select(
        "fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks))).alias("tab", "key")
    )
    sizes = keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # written, so that a frequent bucket's rows may be dealt out in the join and go no further together
    both = materialise(keyed.join(sizes, ["tab", "key"]), "buckets")
    small = both.where(F.col("n") <= bucket_cap).groupBy("tab", "key").agg(F.collect_list("fp").alias("fps"))

    def verify(batches):
        for b in batches:
            found = []
            for fps in b.column(0):
                found += spanning_edges(np.sort(np.array(fps.values, np.int64)), max_bits)
            a = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

    near = in_arrow(small.select("fps"), verify, "a long, b long")
    flips = [0] + [(1 << i) - ((1 << 64) if i == 63 else 0) for i in range(BITS)]
    flip = F.array(*(F.col("fp").bitwiseXOR(F.lit(f).cast("long")) for f in flips))
    large = both.where(F.col("n") > bucket_cap).select("fp").distinct().select("fp", F.explode(flip).alias("point"))
    if max_bits == 1:  # only points that are fingerprints themselves make distance one
        large = large.join(distinct.select(F.col("fp").alias("point")), "point")
    meet = large.groupBy("point").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps"))
    if max_bits == 1:
        meet = meet.withColumn("a", F.col("point"))
    far = meet.where(F.size("fps") > 1).select("a", F.explode("fps").alias("b")).where("a <> b")
    return near.unionByName(far).distinct()


#: Edges from which on nodes with many of them are told apart, and ways by which their rows are dealt.
MANY, WAYS = 4096, 32


def _dealt_join(left: DataFrame, right: DataFrame, key: str, hubs: list[int], how: str = "inner") -> DataFrame:
    """`left` joined with `right`, which has one row for each key: rows of the keys among `hubs` are
    dealt over several tasks."""
    if not hubs:
        return left.join(right, key, how)
    frequent = F.col(key).isin(hubs)
    way = F.when(frequent, F.pmod(F.monotonically_increasing_id(), F.lit(WAYS)).cast("int")).otherwise(0)
    ways = F.when(frequent, F.sequence(F.lit(0), F.lit(WAYS - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("_way", way).join(right.withColumn("_way", F.explode(ways)), [key, "_way"], how).drop("_way")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of `edges` (a, b: longs), a root that its component shares.

    Every round points each node at its smallest neighbour's smallest neighbour and contracts the
    edges; nodes without edges are done.  What reaches the driver are counts, and the nodes that are
    at more than a hundredth of all edges' ends, of which there are under a hundred."""
    spark = edges.sparkSession
    edges = materialise(edges.where("a <> b").select("a", "b").distinct(), "edges")
    maps: list[DataFrame] = []
    for _ in range(max_rounds):
        n = edges.count()
        if not n:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select(F.col("a").alias("v"), F.least("a", "m").alias("m"), "n")
        hubs = []
        if n > MANY:
            least = materialise(least, "least")
            hubs = [r[0] for r in least.where(F.col("n") > n // 50).select("v").collect()]
        least = least.drop("n")
        up = least.select(F.col("v").alias("m"), F.col("m").alias("mm"))
        step = materialise(_dealt_join(least, up, "m", hubs, "left").select("v", F.coalesce("mm", "m").alias("p")), "step")
        maps.append(step)
        moved = _dealt_join(_dealt_join(edges, step.toDF("a", "pa"), "a", hubs), step.toDF("b", "pb"), "b", hubs)
        edges = materialise(moved.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    else:
        raise RuntimeError("the components did not settle")
    if not maps:
        return spark.createDataFrame([], "node long, root long")
    out = maps[0].toDF("node", "root")
    for step in maps[1:]:
        out = out.join(step.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """Per document: `id`, `th`, `fp`, `root` (one fingerprint for each component) and
    `component_id`, the smallest id that links reach.

    Rows with a null id take part; they get their component's smallest id, or null if it has
    none.  Repeated rows are kept, each with the same result.  An empty table gives no rows."""
    prints = materialise(simhash(docs, id_col, text_col, width), "fingerprints")
    per = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    linked = components(links(per.select("fp"), max_bits))
    rooted = materialise(
        per.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(least, "root"), "fp").select("id", "th", "fp", "root", "component_id")


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many rows of `h` (rows, words of 64 bits) have each bit: eight byte lanes at once, in
    runs short enough that no lane overflows."""
    width = h.shape[1]
    total = np.zeros((8, 8 * width), np.int64)
    lane = np.uint64(0x0101010101010101)
    for lo in range(0, len(h), 255):
        part = h[lo : lo + 255]
        for b in range(8):
            total[b] += np.add.reduce((part >> np.uint64(b)) & lane, axis=0).view(np.uint8)
    return total.T.reshape(-1)


def widened(h: np.ndarray, words: int) -> np.ndarray:
    """Each 64-bit hash as `words` independent ones."""
    x = h[:, None] + np.arange(1, words + 1, dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bands of a text's shingle minima, and minima in a band: texts that share 0.8 of their shingles
#: have an equal band in all but 0.2 % of cases.
BANDS, IN_BAND = 16, 5


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text, in order."""
    words, step = (text or b"").lower().split(), 1 << 15
    parts = [np.array(shingle_hashes(words[lo : lo + step + width - 1], width), np.uint64) for lo in range(0, max(1, len(words) - width + 1), step)]
    return np.unique(np.concatenate(parts)) if words else np.zeros(0, np.uint64)


def band_keys(h: np.ndarray) -> np.ndarray:
    """A key for each band, of the minima that `IN_BAND` hash functions take over a set."""
    odd = np.random.default_rng(5).integers(0, 1 << 63, (BANDS + 1) * IN_BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if not len(h):
        return np.zeros(BANDS, np.uint64)
    by, least = odd[IN_BAND:, None], np.full(BANDS * IN_BAND, np.iinfo(np.uint64).max)
    for lo in range(0, len(h), 1024):
        np.minimum(least, (by * h[None, lo : lo + 1024]).min(1), out=least)
    return (least.reshape(BANDS, IN_BAND) * odd[:IN_BAND]).sum(1, dtype=np.uint64)


def wide_fingerprint(text: bytes | None, width: int, long_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a whole text's distinct shingles, a fingerprint of `long_words` x 64 bits and the band
    keys; zeros where there are none."""
    h, step = shingle_set(text, width), 1 << 15
    counts = np.zeros(64 * long_words, np.int64)
    for lo in range(0, len(h), step):
        counts += bit_counts(widened(h[lo : lo + step], long_words))
    return np.packbits((2 * counts > len(h)).astype(np.uint8), bitorder="little").view(np.uint64), band_keys(h)


def bits_apart(similarity: float, bits: int) -> int:
    """Bits by which fingerprints differ on average if two sets of one size have this share of
    their union in common: their vectors' cosine is 2 s / (1 + s)."""
    return int(bits * np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def limits(similarity: float, bits: int) -> tuple[int, int]:
    """Distances up to which sets are surely similar enough, and beyond which surely not.  The
    cosine of similar sets is 2 s / (1 + s) at least, and that of others at most sqrt(s), where one
    holds the other; the distance scatters by the root of its binomial variance about the mean."""
    far, p = bits_apart(similarity, bits), np.arccos(np.sqrt(similarity)) / np.pi
    q = far / bits
    return max(0, int(bits * p - 4 * np.sqrt(bits * p * (1 - p)))), int(far + 5 * np.sqrt(bits * q * (1 - q)))


def _near_forest(ids: np.ndarray, v: np.ndarray, c: np.ndarray, tab: int, sure: int, far: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Edges of a spanning forest of the sure links among fingerprints `v` (rows of 64-bit words),
    and which rows are in a pair that is neither sure, nor far, nor joined by the forest, and has
    its first equal band in `tab`."""
    root = np.arange(len(ids))  # labels; the smaller of two merged ones stays
    edges, open_ = [], []
    for i in range(len(ids) - 1):
        d = np.bitwise_count(v[i + 1 :] ^ v[i]).sum(1, dtype=np.int32)
        near = i + 1 + np.flatnonzero(d <= far)
        if not len(near):
            continue
        is_sure = d[near - i - 1] <= sure
        for j in near[is_sure & (root[near] != root[i])].tolist():
            a, b = root[i], root[j]
            if a != b:
                root[root == max(a, b)] = min(a, b)
                edges.append((int(ids[i]), int(ids[j])))
        rest = near[~is_sure]
        if len(rest):
            open_.append((i, rest[(c[rest] == c[i]).argmax(1) == tab].astype(np.int32)))
    border = np.zeros(len(ids), bool)
    for i, js in open_:
        js = js[root[js] != root[i]]
        border[js] = True
        border[i] |= len(js) > 0
    return edges, border


def _exact_forest(ids: np.ndarray, v: np.ndarray, c: np.ndarray, tab: int, sure: int, far: int, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs that `_near_forest` leaves open and whose sets of
    shingles have the similarity."""
    size = np.array([len(x) for x in sets])
    cuts = np.concatenate(([0], np.cumsum(size)))
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mine = np.zeros(len(number) + 1, bool)
    root = np.arange(len(ids))
    edges = []
    for i in range(len(ids) - 1):
        d = np.bitwise_count(v[i + 1 :] ^ v[i]).sum(1, dtype=np.int32)
        near = i + 1 + np.flatnonzero((d > sure) & (d <= far))
        near = near[(c[near] == c[i]).argmax(1) == tab]
        own = number[cuts[i] : cuts[i + 1]]
        mine[own] = True
        for j in near[root[near] != root[i]].tolist():
            a, b = root[i], root[j]
            if a == b:
                continue
            both = int(np.count_nonzero(mine[number[cuts[j] : cuts[j + 1]]]))
            if both >= similarity * (size[i] + size[j] - both) - 1e-9:
                root[root == max(a, b)] = min(a, b)
                edges.append((int(ids[i]), int(ids[j])))
        mine[own] = False
    return edges


#: Bits of the filter that picks the texts to be read again.
FILTER = 1 << 24


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, long_words: int = 8, bucket_cap: int = 4096) -> DataFrame:
    """Per document: `id`, `th` (a hash of the text) and `root`, one number for each group of near
    duplicates: texts linked by chains of pairs whose sets of shingles overlap by `similarity`.
    Nulls and repeated rows: see `near_duplicates`.  The method: see `text_groups`."""
    marked, rooted = text_groups(docs, id_col, text_col, width, similarity, long_words, bucket_cap)
    # a frequent text's rows are dealt out by the join, which nothing in its stage precedes or follows
    return marked.select("id", "th").join(rooted.select("th", "root"), "th").select("id", "th", "root")


def text_groups(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float, long_words: int, bucket_cap: int) -> tuple[DataFrame, DataFrame]:
    """(id, th) of every document, and (th, least, root) of every text: the smallest of its
    documents' ids (as a struct that puts nulls last) and its group.

    Candidates share a band of minima over their shingles (see `BANDS`).  The Hamming distance of
    `long_words` x 64 SimHash bits over the shingles settles those that are surely alike or surely
    not; the texts of all other pairs are read again, and their sets of shingles compared.  Equal
    texts collapse first.  A bucket gives a spanning forest of its links.  One with more than
    `bucket_cap` texts is first thinned by its pivot, and the rest dealt into parts (see
    `_dealt_large`), so it loses nothing either."""
    rows = spread(take(docs, id_col, text_col)).toDF("id", "text")
    rows = rows.select("id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))

    def prints(batches):
        for b in batches:
            made = [wide_fingerprint(t.as_py(), width, long_words) for t in b.column(2)]
            own = pa.ListArray.from_arrays(np.arange(len(made) + 1, dtype=np.int32) * BANDS, np.concatenate([c for _, c in made]).view(np.int64)) if made else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([v.tobytes() for v, _ in made], pa.binary()), own], names=["id", "th", "v", "c"])

    kind = rows.schema["id"].dataType.simpleString()
    marked = materialise(in_arrow(rows, prints, f"id {kind}, th long, v binary, c array<long>"), "prints")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least")
    texts = materialise(marked.groupBy("th").agg(F.first("v").alias("v"), F.first("c").alias("c"), least), "texts")
    keyed = texts.select("th", F.posexplode("c").alias("tab", "key"))
    sizes = keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(keyed.join(sizes, ["tab", "key"]), "shared")
    full = texts.select("th", "v", "c")
    sure, far = limits(similarity, 64 * long_words)
    dealt = shared.where(F.col("n") <= bucket_cap).join(full, "th").select("tab", "key", F.lit(0).alias("pair"), "th", "v", "c")
    large = shared.where(F.col("n") > bucket_cap)
    pivoted = None
    if not large.isEmpty():
        more, pivoted = _dealt_large(large.join(full, "th").select("tab", "key", "th", "v", "c"), sure, far, bucket_cap)
        dealt = dealt.unionByName(more)
    dealt = dealt.groupBy("tab", "key", "pair").agg(F.collect_list(F.struct("th", "v", "c")).alias("m"))

    def members(m):
        """A bucket's members in order of their numbers, with fingerprints and band keys."""
        m = m.values
        ids = m.field("th").to_numpy(zero_copy_only=False)
        order = np.argsort(ids)
        v = np.frombuffer(b"".join(m.field("v").to_pylist()), np.uint64).reshape(-1, long_words)
        c = m.field("c").flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
        return m, order, ids[order], v[order], c[order]

    def compare(batches):
        for b in batches:
            for tab, key, pair, ms in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3), strict=True):
                _, _, ids, v, c = members(ms)
                edges, border = _near_forest(ids, v, c, tab, sure, far)
                e, at = np.array(edges, np.int64).reshape(-1, 2), np.flatnonzero(border)
                n, k = len(e), len(at)
                if n + k:
                    yield pa.RecordBatch.from_pydict({
                        "tab": pa.array([tab] * (n + k), pa.int32()), "key": pa.array([key] * (n + k), pa.int64()), "pair": pa.array([pair] * (n + k), pa.int32()),
                        "a": pa.array(np.concatenate((e[:, 0], ids[at]))), "b": pa.array(e[:, 1].tolist() + [None] * k, pa.int64()),
                        "v": pa.array([None] * n + [x.tobytes() for x in v[at]], pa.binary()), "c": pa.array([None] * n + c[at].tolist(), pa.list_(pa.int64())),
                    })

    compared = materialise(in_arrow(dealt, compare, "tab int, key long, pair int, a long, b long, v binary, c array<long>"), "compared")
    border = compared.where("b IS NULL").select("tab", "key", "pair", F.col("a").alias("th"), "v", "c")
    # few texts are read again: a filter of fixed size spares the others a join
    at = F.pmod(F.col("th"), F.lit(FILTER))
    bits = np.zeros(FILTER // 8, np.uint8)
    for r in border.groupBy((at / 32768).cast("int").alias("k")).agg(F.bitmap_construct_agg((at % 32768).cast("long")).alias("m")).collect():
        bits[r["k"] * 4096 : r["k"] * 4096 + 4096] = np.frombuffer(r["m"], np.uint8)

    def sets(batches):
        for b in batches:
            place = b.column(0).to_numpy() % FILTER
            b = b.filter(pa.array((bits[place >> 3] >> (place & 7) & 1).astype(bool)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t.as_py(), width).tobytes() for t in b.column(1)], pa.binary())], names=["th", "s"])

    def verify(batches):
        for b in batches:
            found = []
            for tab, ms in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                m, order, ids, v, c = members(ms)
                s = m.field("s").to_pylist()
                found += _exact_forest(ids, v, c, tab, sure, far, [np.frombuffer(s[i], np.uint64) for i in order], similarity)
            e = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])

    edges = compared.where("b IS NOT NULL").select("a", "b")
    if pivoted is not None:
        edges = edges.unionByName(pivoted)
    if bits.any():
        read = in_arrow(rows.select("th", "text"), sets, "th long, s binary").groupBy("th").agg(F.first("s").alias("s"))
        again = border.join(read, "th").groupBy("tab", "key", "pair").agg(F.collect_list(F.struct("th", "v", "c", "s")).alias("m"))
        edges = edges.unionByName(in_arrow(again.select("tab", "m"), verify, "a long, b long"))
    linked = components(edges)
    rooted = texts.select("th", "least").join(linked.withColumnRenamed("node", "th"), "th", "left")
    return marked, materialise(rooted.select("th", "least", F.coalesce("root", "th").alias("root")), "rooted")


def _dealt_large(members: DataFrame, sure: int, far: int, cap: int) -> tuple[DataFrame, DataFrame]:
    """Members (tab, key, th, v, c) of large buckets, dealt into `pair`s of parts that hold about
    `cap` texts and between them every two texts that may yet have to be compared; and edges.

    Texts surely alike a bucket's pivot, its smallest text, are linked to it, and so to each other.
    They only have to meet the texts on the rim: by the triangle inequality, those beyond `far` from
    all of them can't be alike them.  So where many texts of one origin fill a bucket, as many copies
    with small changes do, each is compared once; only the others meet each other, part by part."""
    pivots = members.groupBy("tab", "key").agg(F.min("th").alias("pivot"), F.min_by("v", "th").alias("pv"))

    def place(batches):
        for b in batches:
            v, pv = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint64).reshape(len(b), -1) for i in (3, 6))
            d = np.bitwise_count(v ^ pv).sum(1, dtype=np.int32)
            zone = (d > sure).astype(np.int32) + (d > sure + far)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(6)), pa.array(zone)], names=["tab", "key", "th", "v", "c", "pivot", "zone"])

    met = members.join(pivots, ["tab", "key"]).select("tab", "key", "th", "v", "c", "pivot", "pv")
    placed = materialise(in_arrow(met, place, "tab int, key long, th long, v binary, c array<long>, pivot long, zone int"), "placed")
    edges = placed.where("zone = 0 AND th <> pivot").select(F.col("th").alias("a"), F.col("pivot").alias("b"))
    count = lambda c: F.count_if(c).alias
    sizes = placed.groupBy("tab", "key").agg(count(F.col("zone") == 0)("inner"), count(F.col("zone") == 1)("rim"), count(F.col("zone") > 0)("others"))
    known = materialise(placed.join(sizes, ["tab", "key"]), "placed")
    half = max(1, cap // 2)
    parts = lambda n: F.greatest(F.ceil(F.col(n) / half), F.lit(1)).cast("int")
    own = lambda n: F.pmod(F.xxhash64("th"), parts(n)).cast("int")
    # every two parts of the others: the smaller number, then the larger
    among = F.transform(F.sequence(F.lit(0), parts("others") - 1), lambda k: F.least(k, own("others")) * parts("others") + F.greatest(k, own("others")))
    # every part of the inner texts with every part of the rim, under negative numbers
    cell = lambda i, j: -1 - (i * parts("rim") + j)
    to_rim = F.transform(F.sequence(F.lit(0), parts("rim") - 1), lambda j: cell(own("inner"), j))
    to_inner = F.transform(F.sequence(F.lit(0), parts("inner") - 1), lambda i: cell(i, own("rim")))
    pairs = F.when(F.col("zone") == 0, to_rim).when(F.col("zone") == 1, F.concat(among, to_inner)).otherwise(among)
    meeting = known.where((F.col("zone") > 0) | (F.col("rim") > 0))
    return meeting.select("tab", "key", F.explode(pairs).alias("pair"), "th", "v", "c"), edges


def similar_texts(docs: DataFrame, **options) -> DataFrame:
    """`similar_groups` with `component_id`, the group's smallest id (null if it has none)."""
    found = materialise(similar_groups(docs, **options), "groups")
    least = found.groupBy("root").agg(F.min("id").alias("component_id"))
    return found.join(least, "root").select("id", "th", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, long_words: int = 8, bucket_cap: int = 4096) -> DataFrame:
    """The rows of `docs` but for near duplicates (see `text_groups`): of each group the row with
    the smallest id (nulls last, then the text's hash) stays, and of equal rows one.

    Ids are of any type that has an order.  All null, empty and wordless texts make one group.  An
    empty table gives no rows; further columns, of whatever names, stay as they are."""
    columns = docs.columns
    _, rooted = text_groups(docs, id_col, text_col, width, similarity, long_words, bucket_cap)
    kept = rooted.groupBy("root").agg(F.min(F.struct("least.none", "least.id", "th")).alias("k"))
    named = lambda id_: F.coalesce(id_.cast("string"), F.lit("")).alias("name")
    kept = kept.select(F.col("k.none").alias("none"), named(F.col("k.id")), F.col("k.th").alias("th"))
    rows = with_row(docs, id_col, text_col).toDF("_row", "id", "text")
    rows = rows.select("_row", F.col("id").isNull().alias("none"), named(F.col("id")), F.xxhash64("text").alias("th"))
    # equal rows are cut to one before rows move, so many of them never meet; the join follows the same keys
    nth = F.row_number().over(Window.partitionBy("none", "name", "th").orderBy(F.xxhash64("_row")))
    once = rows.withColumn("nth", nth).where("nth = 1")
    return rows_of(once.join(kept, ["none", "name", "th"], "left_semi"), columns)
