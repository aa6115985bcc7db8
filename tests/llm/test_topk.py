import math

import numpy as np
import pytest

from skyloom.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, id string, norm double, V int"


def table(spark, rows):
    return spark.createDataFrame([(a, b, "x", 1.0, 2) for a, b in rows], SCHEMA)


def slow(rows, asked, k):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in ok if asked(i)}:
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def vectors(n, d, seed):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, d)) * r.exponential(1.0, (n, 1)) @ np.diag(np.linspace(2, 0.1, d))
    return [(int(i), [float(x) for x in row]) for i, row in enumerate(v.astype(np.float32))]


@pytest.mark.parametrize(("blocks", "queries"), [(8192, 2048), (50, 7)])
def test_brute_force(spark, blocks, queries):
    rows = vectors(400, 8, 3)
    hot = rows[17][1]
    rows += [(1000 + i, hot) for i in range(150)]  # ties, by the hundred
    rows += [(2000, None), (2050, [1.0, None] + [0.0] * 6), (2100, [math.inf] + [0.0] * 7), (2150, [math.nan] + [1.0] * 7), (2200, [0.0] * 8), (None, rows[1][1])]
    rows += rows[3:5]  # repeated rows
    df = table(spark, rows)
    got = T.top_k(df, df.where("vec_id % 20 = 0"), 5, query_block=queries, item_block=blocks)
    assert sorted(tuple(r) for r in got.collect()) == slow(rows, lambda i: i % 20 == 0, 5)


def test_any_number_of_partitions(spark, monkeypatch):
    """Answers hold when a range sort gives many more blocks than it was asked for, or fewer."""
    rows = vectors(600, 8, 5)
    df = table(spark, rows)
    want = slow(rows, lambda i: i % 20 == 0, 5)
    plain = type(df).repartitionByRange
    for n in (211, 2):
        monkeypatch.setattr(type(df), "repartitionByRange", lambda self, k, *cols, n=n: plain(self, n, *cols))
        got = T.top_k(df, df.where("vec_id % 20 = 0"), 5, item_block=100)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_blocks_are_as_coarse_as_memory_allows():
    """Vectors of one length, which no bound prunes: a vector is copied once for each block of the other side."""
    n, d = 50_000_000, 64
    rows = T.block_rows(n, d, 16)
    assert rows == 65536 and rows * d * 8 <= T.BLOCK_BYTES and -(-n // rows) == 763  # 6104 of the 8192 rows before
    assert T.block_rows(1000, 64, 16) == 63 and T.block_rows(10, 10**9, 1) == 1


def test_few_rows(spark):
    rows = vectors(3, 4, 1)
    df = table(spark, rows)
    assert sorted(tuple(r) for r in T.top_k(df, df, 5).collect()) == slow(rows, lambda i: True, 5)
    assert T.top_k(table(spark, []), table(spark, []), 5).count() == 0
    assert T.top_k(df, df.where("vec_id < 0"), 5).count() == 0
    one = table(spark, rows[:1])
    assert T.top_k(one, one, 5).count() == 0


def test_large_components(spark):
    rows = [(0, [1e9, 1.0]), (1, [1e9, 2.0]), (2, [-1e9, 3.0]), (3, [0.5, -0.5])]
    df = table(spark, rows)
    got = {(r.query_id, r.vec_id): r.score for r in T.top_k(df, df, 3).collect()}
    # whole numbers throughout, and the bounds of a long beyond them
    assert got[0, 1] == (1 << 63) - 1 and got[0, 2] == -(1 << 63) and got[0, 3] == 256 * 10**9 * 128 - 256 * 128


def test_pruning_is_exact():
    r = np.random.default_rng(9)
    x = np.floor(r.normal(size=(900, 12)) * r.exponential(60, (900, 1)))
    ids = np.arange(900)
    q, qi = x[::30], ids[::30]
    rot = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    top, found = T.best(q, qi, np.full(len(q), -np.inf), x, ids, rot, 5, step=64)
    for k, i in enumerate(qi):
        s = x @ q[k]
        want = [j for j in np.lexsort((ids, -s)) if j != i][:5]
        assert found[k].tolist() == want and np.array_equal(top[k], s[want])


def test_lengths_differ(spark):
    """Vectors of another length than the commonest take no part, as items or as queries."""
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [9.0, 9.0, 9.0]), (4, [2.0, -1.0]), (5, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id): r.score for r in T.top_k(df, df, k=5).collect()}
    assert got == {(1, 2): 256 * 128, (1, 4): 256 * 512, (2, 1): 256 * 128, (2, 4): 128 * 512 - 128 * 256, (4, 1): 256 * 512, (4, 2): 128 * 512 - 128 * 256}
    odd = spark.createDataFrame([(7, [1.0, 2.0, 3.0])], df.schema)
    assert T.top_k(df, odd, k=5).isEmpty()
