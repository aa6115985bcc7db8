"""Exact top-k inner products by norm-sorted, SVD-rotated partial sums.

Items lie in blocks of falling length.  Both sides are cut as coarsely as a task's memory allows
(see `block_rows`), as a vector is copied to every block of the other side that it may meet.  Per
pair of a query block and an item block, a task
multiplies the first few coordinates in the basis of the items' singular vectors; Cauchy-Schwarz
bounds what the remaining coordinates can add, and items that cannot reach a query's k-th best
score so far are dropped before the next coordinates.  Survivors are scored in exact integers.
The longest block runs first and gives every query a threshold, by which whole pairs of blocks
are then pruned before their vectors are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, materialise, ship, take

SCALE = 256
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 52)


def quantised(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double> of whole numbers, norm): floor(256 x) of every component.  Vectors
    that are null or empty, or hold a null or non-finite component, are left out."""
    rows = take(table, id_col, vec_col).toDF("id", "raw")
    ok = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & (F.size("raw") > 0) & ok)
    # floor() of a double is a long, which bounds what takes part: larger values saturate
    v = F.transform("raw", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    rows = rows.select("id", v.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def rotation(items: DataFrame) -> np.ndarray:
    """The right singular vectors of the items, largest first: a d x d matrix, from the d x d sum
    of outer products that the tasks add up (never more than d * d numbers reach the driver)."""

    def gram(batches):
        total = None
        for b in batches:
            if len(b):
                x = np.array(b.column(0).flatten()).reshape(len(b), -1)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            cells = pa.ListArray.from_arrays(np.arange(len(total) + 1, dtype=np.int32) * len(total), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), cells], names=["i", "row"])

    def added(rows: pa.Table) -> pa.Table:
        total = np.array(rows.column("row").combine_chunks().flatten()).reshape(len(rows), -1).sum(0)
        return pa.table({"i": rows.column("i")[:1], "row": pa.array([total], pa.list_(pa.float64()))})

    rows = in_arrow(items.select("v"), gram, "i int, row array<double>").groupBy("i").applyInArrow(added, "i int, row array<double>").toArrow()
    d = len(rows)
    g = np.zeros((d, d))
    if d:
        g[np.array(rows.column("i"))] = np.array(rows.column("row").combine_chunks().flatten()).reshape(d, d)
    if not np.isfinite(g).all():
        return np.eye(d)
    return np.linalg.eigh(g)[1][:, ::-1]


def best(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, x_ids: np.ndarray, rot: np.ndarray, k: int, step: int = 512):
    """The k best items of each query in this block, as (query index, item index, score).

    `floor`: a score that the query's k-th best reaches anyway; lower scores aren't wanted."""
    order = np.lexsort((x_ids, -np.einsum("ij,ij->i", x, x)))
    x, x_ids = x[order], x_ids[order]
    d = q.shape[1]
    qr, qn = q @ rot, np.sqrt(np.einsum("ij,ij->i", q, q))
    cuts = sorted({min(d, c) for c in (d // 4, d // 2, 3 * d // 4, d)} - {0})
    q_tail = [np.sqrt(np.einsum("ij,ij->i", qr[:, c:], qr[:, c:])) for c in cuts]
    big = len(x) > 0 and np.abs(q).max() * np.abs(x).max() * d >= EXACT  # then scores are whole numbers of Python
    top = np.full((len(q), k), -np.inf, object if big else float)  # scores, falling
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    for lo in range(0, len(x), step):
        xs, xi = x[lo : lo + step], x_ids[lo : lo + step]
        xn = np.sqrt(np.einsum("ij,ij->i", xs, xs))
        need = np.maximum(floor, top[:, -1].astype(float))
        slack = 1e-9 * (qn * (xn[0] + 1) + 1)
        live = np.flatnonzero(qn * xn[0] + slack >= need)  # of the rest, no item is long enough, here or later
        if not len(live):
            break
        xr, cols, part, c0 = xs @ rot, np.arange(len(xs)), 0.0, 0
        for c, tail in zip(cuts, q_tail, strict=True):
            part = part + qr[live, c0:c] @ xr[cols, c0:c].T
            rest = np.sqrt(np.einsum("ij,ij->i", xr[cols, c:], xr[cols, c:]))
            can = part + tail[live][:, None] * rest >= (need - slack)[live][:, None]
            keep = can.any(0)
            if not keep.all():
                cols, part, can = cols[keep], part[:, keep], can[:, keep]
            c0 = c
            if not len(cols):
                break
        if not len(cols):
            continue
        a, b = np.nonzero(can)
        a, b = live[a], cols[b]
        own = q_ids[a] == xi[b]
        a, b = a[~own], b[~own]
        for i, (score, item) in _merged(a, exact(q, xs, a, b, big), xi[b], top, ids, k):
            top[i], ids[i] = score, item
    return top, ids


def exact(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray, big: bool) -> np.ndarray:
    """Integer inner products of q[a] and x[b], saturating at the bounds of a long."""
    if not len(a):
        return np.zeros(0)
    if not big:
        out = np.empty(len(a))
        for lo in range(0, len(a), 65536):
            out[lo : lo + 65536] = np.einsum("ij,ij->i", q[a[lo : lo + 65536]], x[b[lo : lo + 65536]])
        return out
    whole = lambda m: [[int(y) for y in r] for r in m]
    qs, xs = whole(q), whole(x)
    lim = (1 << 63) - 1
    return np.array([max(-lim - 1, min(lim, sum(s * t for s, t in zip(qs[i], xs[j], strict=True)))) for i, j in zip(a, b, strict=True)], dtype=object)


def _merged(a, scores, items, top, ids, k):
    """For each query with new scores, its k best of old and new."""
    if not len(a):
        return
    order = np.argsort(a, kind="stable")
    a, scores, items = a[order], scores[order], items[order]
    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    for lo, hi in zip(starts, np.append(starts[1:], len(a)), strict=True):
        i = a[lo]
        s, t = np.concatenate([top[i], scores[lo:hi]]), np.concatenate([ids[i], items[lo:hi]])
        pick = sorted(range(len(s)), key=lambda j: (-s[j], t[j]))[:k] if s.dtype == object else np.lexsort((t, -s))[:k]
        yield i, (s[pick], t[pick])


#: Bytes of vectors in a block of one side.
BLOCK_BYTES = 32 << 20


def block_rows(n: int, d: int, at_least: int) -> int:
    """Rows in a block of `n` vectors of length `d`: as many as fit, but for `at_least` blocks."""
    return max(1, min(BLOCK_BYTES // (8 * max(d, 1)), -(-n // at_least)))


def top_k(table: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", query_block: int | None = None, item_block: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products among the
    rows of `table` with another id; ties go to the smaller id.

    Blocks hold `query_block` and `item_block` rows, by default what `block_rows` says; answers
    don't depend on them.

    Fewer than k other rows give as many; an empty table or query set gives none.  Vectors that
    are unusable (see `quantised`) take no part on either side, nor do those whose length is not the
    table's commonest (of equally common ones the longest).  Repeated ids are further items."""
    spark = table.sparkSession
    ship(spark)
    items = materialise(quantised(table, id_col, vec_col), "items")
    out = "query_id long, vec_id long, score long"
    common = items.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    alike, n = F.size("v") == common["d"], common["count"]
    items, asked = items.where(alike), quantised(queries, id_col, vec_col).where(alike)
    rot = rotation(items)
    # blocks of falling length; the id splits runs of equal length, so no block outgrows the rest
    cores = spark.sparkContext.defaultParallelism
    blocks = -(-n // (item_block or block_rows(n, len(rot), 2 * cores)))
    cut = items.repartitionByRange(blocks, F.desc("norm"), "id", F.xxhash64("v")).withColumn("ib", F.spark_partition_id())
    items = materialise(cut, "blocks")
    m = asked.count()
    q_blocks = max(1, -(-m // (query_block or block_rows(m, len(rot), 1))))
    asked = materialise(asked.dropDuplicates(["id", "v"]).withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int")), "queries")

    def task(qs: pa.Table, xs: pa.Table) -> pa.Table:
        if not len(qs) or not len(xs):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        flat = lambda t: np.array(t.column("v").combine_chunks().flatten()).reshape(len(t), -1)
        q_ids, x_ids = (np.array(t.column("id"), np.int64) for t in (qs, xs))
        top, ids = best(flat(qs), q_ids, np.array(qs.column("floor"), float), flat(xs), x_ids, rot, k)
        a, b = np.nonzero(top > -np.inf)
        score = pa.array([int(s) for s in top[a, b]], pa.int64())
        return pa.table({"query_id": q_ids[a], "vec_id": ids[a, b], "score": score})

    def scored(qs: DataFrame, xs: DataFrame, pairs: DataFrame) -> DataFrame:
        """`pairs` (qb, ib) of blocks: each side is copied to the pairs that it is in."""
        left = qs.join(pairs.toDF("qb", "l"), "qb").select("id", "v", "floor", F.col("qb").alias("q1"), F.col("l").alias("i1"))
        right = xs.join(pairs.toDF("r", "ib"), "ib").select("id", "v", F.col("r").alias("q2"), F.col("ib").alias("i2"))
        return left.groupBy("q1", "i1").cogroup(right.groupBy("q2", "i2")).applyInArrow(task, out)

    def ranked(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    # the blocks that the table really has: a range sort may give fewer or more than it was asked for
    spans = items.groupBy("ib").agg(F.max("norm").alias("longest"))
    first, last = items.agg(F.min("ib"), F.max("ib")).first()
    wide = materialise(asked.select("qb").distinct().withColumn("ib", F.lit(first).cast("int")), "first")
    head = materialise(ranked(scored(asked.withColumn("floor", F.lit(float("-inf"))), items.where(F.col("ib") == first), wide)).select("query_id", "vec_id", "score"), "head")
    floors = head.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("floor"))
    asked = materialise(asked.join(floors, asked["id"] == floors["query_id"], "left").select("id", "v", "norm", "qb", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")), "asked")
    needs = asked.groupBy("qb").agg(F.max("norm").alias("reach"), F.min("floor").alias("least"))
    # every block of queries against the blocks long enough to matter; both lists hold one row a block
    every = needs.withColumn("ib", F.explode(F.sequence(F.lit(first), F.lit(last)))).where(F.col("ib") != first)
    pairs = every.join(spans, "ib").where(F.col("reach") * F.col("longest") * (1 + 1e-9) >= F.col("least")).select("qb", "ib")
    rest = scored(asked, items.where(F.col("ib") != first), materialise(pairs, "pairs"))
    return ranked(head.unionByName(rest)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
