"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

The covariance of the distinct vectors, centred before anything is multiplied, is factored with
pivots: P'VP = LL'.  Plane rotations from the right make the columns of the triangular factor L
orthogonal; their squared lengths are the eigenvalues of V, and the columns at unit length, rows
put back in place, its eigenvectors.  Working on L instead of V keeps small eigenvalues accurate.

Spark does what grows with the table: distinct vectors, exact sums, the scatter as a sum of d x d
matrices of the tasks (added by rows, so d x d numbers reach the driver), the projections and
their covariance.  Vectors travel as packed whole numbers of the least width that holds them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialise, take

SCALE = 64
TOP = (1 << 63) - 1
#: Rows of a block that is projected at once.
ROWS = 4096


def pack(x: np.ndarray) -> list[bytes]:
    """Each row of whole numbers as bytes of the least width that holds it, which
    the length tells: equal rows are equal bytes."""
    width = np.where((np.abs(x) < 1 << 15).all(1), 2, np.where((np.abs(x) < 1 << 31).all(1), 4, 8))
    out: list[bytes] = [b""] * len(x)
    for w in (2, 4, 8):
        at = np.flatnonzero(width == w)
        for i, row in zip(at, x[at].astype(f"<i{w}"), strict=True):
            out[i] = row.tobytes()
    return out


def unpack(raw: pa.Array, d: int) -> np.ndarray:
    """The rows of `pack` as longs."""
    raw = raw.cast(pa.binary())
    ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    size = np.diff(ends)
    out = np.empty((len(raw), d), np.int64)
    for w in (2, 4, 8):
        at = np.flatnonzero(size == w * d)
        if len(at) == len(raw):
            return data[ends[0] : ends[-1]].view(f"<i{w}").reshape(-1, d).astype(np.int64)
        for i in at:
            out[i] = data[ends[i] : ends[i + 1]].copy().view(f"<i{w}")
    return out


def packed(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, d, x): floor(64 c) of every component c, packed.  A constant added to all would change
    no result, as everything is centred.  Vectors that are null or empty, or hold
    a null or non-finite component, are left out; numbers that no long holds become the nearest."""
    rows = take(table, id_col, vec_col).toDF("id", "raw")
    ok = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(F.col("raw").isNotNull() & (F.size("raw") > 0) & ok)
    kind = rows.schema["id"].dataType.simpleString()

    def apply(batches):
        for b in batches:
            raw = b.column(1)
            size = np.array(raw.value_lengths(), np.int64)
            flat = np.array(raw.flatten().cast(pa.float64()))
            ends = np.r_[0, np.cumsum(size)]
            out: list[bytes] = [b""] * len(b)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                c = flat.reshape(-1, d) if len(at) == len(b) else np.stack([flat[ends[i] : ends[i + 1]] for i in at])
                x = np.clip(np.floor(c * SCALE), -(2.0**62), 2.0**62).astype(np.int64)
                for i, p in zip(at, pack(x), strict=True):
                    out[i] = p
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int32()), pa.array(out, pa.binary())], names=["id", "d", "x"])

    return in_arrow(rows, apply, f"id {kind}, d int, x binary")


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums for each dimension, added in two halves of 32 bits."""

    def apply(batches):
        n, hi, lo = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = unpack(b.column(0), d)
            n, hi, lo = n + len(x), hi + (x >> 32).sum(0), lo + (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(d), pa.int32()), "n": pa.array([n] * d), "hi": hi, "lo": lo})

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = in_arrow(fit.select("x"), apply, "i int, n long, hi long, lo long").groupBy("i").agg(F.sum("n").alias("n"), wide("hi"), wide("lo")).orderBy("i").collect()
    return (int(rows[0]["n"]), [(int(r["hi"]) << 32) + int(r["lo"]) for r in rows]) if rows else (0, [0] * d)


def added(parts: DataFrame, d: int) -> np.ndarray:
    """The sum of matrices given by rows (i, row array<double>), `d` wide."""

    def total(rows: pa.Table) -> pa.Table:
        cells = np.array(rows.column("row").combine_chunks().flatten()).reshape(len(rows), -1).sum(0)
        return pa.table({"i": rows.column("i")[:1], "row": pa.array([cells], pa.list_(pa.float64()))})

    out = np.zeros((d, d))
    for r in parts.groupBy("i").applyInArrow(total, "i int, row array<double>").collect():  # d rows
        out[r["i"]] = r["row"]
    return out


class Centre:
    """The mean of n vectors with the sums S, as whole numbers and what is left below one half, so
    that x - S/n loses no digit however far from zero x lies."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = np.array([(s - w * n) / n for s, w in zip(sums, self.whole, strict=True)])  # (S - wn) is exact
        self.left = [s - w * n for s, w in zip(sums, self.whole, strict=True)]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        m = np.array(self.whole, np.int64)
        if max(np.abs(x).max(initial=0), np.abs(m).max(initial=0)) < 1 << 61:
            return (x - m) - self.rest
        return np.array([[float(int(v) - w) for v, w in zip(row, self.whole, strict=True)] for row in x]).reshape(x.shape) - self.rest

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """The sum over dimensions of (n x - S)^2, exact; what no long holds becomes the largest long."""
        c = self(x)
        about = np.einsum("ij,ij->i", c, c) * float(self.n) ** 2
        out = np.full(len(x), TOP, np.int64)
        fits = about < 0.99 * 2.0**63
        with np.errstate(over="ignore"):  # sums wrap, and come out right as the result fits
            dev = np.int64(self.n) * (x[fits] - np.array(self.whole, np.int64)) - np.array(self.left, np.int64)
            out[fits] = np.einsum("ij,ij->i", dev, dev)
        for i in np.flatnonzero(~fits & (about < 1.01 * 2.0**63)):
            out[i] = min(TOP, sum((self.n * (int(v) - w) - r) ** 2 for v, w, r in zip(x[i], self.whole, self.left, strict=True)))
        return out


def scatter(fit: DataFrame, d: int, of) -> np.ndarray:
    """The sum over the vectors of the outer product of `of(x)`, a task's rows in blocks."""

    def apply(batches):
        total = None
        for b in batches:
            for lo in range(0, len(b), ROWS):
                c = of(unpack(b.column(0).slice(lo, ROWS), d))
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            k = len(total)
            cells = pa.ListArray.from_arrays(np.arange(k + 1, dtype=np.int32) * k, pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), cells], names=["i", "row"])

    return in_arrow(fit.select("x"), apply, "i int, row array<double>")


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with v[order][:, order] = LL': the largest remaining diagonal entry is the next
    pivot.  Ends where what remains is rounding, so L has as many columns as v has rank."""
    a, d = v.copy(), len(v)
    order = np.arange(d)
    least = d * np.finfo(float).eps * max(np.diag(v).max(initial=0), 0)
    for k in range(d):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= least:
            return np.tril(a[:, :k]), order
        a[[k, p]], order[[k, p]] = a[[p, k]], order[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        a[k, k] = np.sqrt(a[k, k])
        a[k + 1 :, k] /= a[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k + 1 :, k])
    return np.tril(a), order


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """L with its columns rotated in pairs until all are orthogonal to rounding.  A round rotates
    disjoint pairs at once, and rounds go about so that every pair meets in each sweep."""
    g = l.copy()
    k = g.shape[1]
    seats = list(range(k)) + [-1] * (k % 2)
    half = len(seats) // 2
    tol = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(max(len(seats) - 1, 0)):
            pairs = [(min(a, b), max(a, b)) for a, b in zip(seats[:half], seats[half:][::-1], strict=True) if a >= 0 and b >= 0]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            i, j = np.array(pairs).T
            x, y = g[:, i], g[:, j]
            a, b, c = (np.einsum("ij,ij->j", p, q) for p, q in ((x, x), (y, y), (x, y)))
            on = np.abs(c) > tol * np.sqrt(a * b)
            if not on.any():
                continue
            turned = True
            i, j, x, y, a, b, c = i[on], j[on], x[:, on], y[:, on], a[on], b[on], c[on]
            z = (b - a) / (2 * c)
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1, z))
            cos = 1 / np.hypot(1, t)
            sin = cos * t
            g[:, i], g[:, j] = cos * x - sin * y, sin * x + cos * y
        if not turned:
            return g
    raise ArithmeticError(f"columns are not orthogonal after {sweeps} sweeps")


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance `v`, falling, and its unit eigenvectors as columns; those of a
    rank below the dimension end where the eigenvalues do."""
    l, order = pivoted_cholesky(v)
    g = one_sided_jacobi(l)
    e = np.einsum("ij,ij->j", g, g)
    by = np.argsort(-e, kind="stable")
    by = by[e[by] > 0]
    u = np.empty((len(v), len(by)))
    u[order] = g[:, by] / np.sqrt(e[by])
    return e[by], u


def whiten(table: DataFrame, top: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): for each vector that takes
    part, its first `top` whitened coordinates.

    The fit is over the distinct vectors, so copies weigh nothing.  Vectors that are unusable (see
    `packed`) take no part, nor do those whose length is not the table's commonest (of equally
    common ones the longest).  Components without variance are left out: a table of one distinct
    vector, or none, gives no rows.  Repeated rows and null ids are whitened like any other."""
    spark = table.sparkSession
    rows = materialise(packed(table, id_col, vec_col), "vectors")
    kind = rows.schema["id"].dataType.simpleString()
    out = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], out)
    d = common["d"]
    rows = rows.where(F.col("d") == d).select("id", "x")
    fit = materialise(rows.select("x").distinct(), "distinct")
    n, sums = exact_sums(fit, d)
    centre = Centre(n, sums)
    v = added(scatter(fit, d, centre), d) / n
    e, u = components((v + v.T) / 2)
    share = e / np.trace(v) if len(e) else e
    e, u, share = e[:top], u[:, :top], share[:top]
    k = len(e)
    if not k:
        return spark.createDataFrame([], out)
    turn = u / np.sqrt(e)
    white = added(scatter(fit, d, lambda x: centre(x) @ turn), k) / n
    error = float(np.abs(white - np.eye(k)).max())

    def apply(batches):
        for b in batches:
            for lo in range(0, len(b), ROWS):
                part = b.slice(lo, ROWS)
                x = unpack(part.column(1), d)
                m = len(x)
                each = lambda a: np.repeat(a, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each(np.arange(m)))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(each(centre.deviation(x))),
                        pa.array((centre(x) @ turn).ravel()),
                        pa.array(np.tile(share, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return in_arrow(rows, apply, out)
