"""Whitening against exact sums and a plain eigensolver."""

import numpy as np
import pytest

from skyloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(vectors: list[list[float]], top=16):
    """(n, S, deviations, whitened, explained) from Python's whole numbers and numpy's eigensolver."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(r) for r in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    centred = lambda rows: np.array([[(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in rows])
    c = centred(fit)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(top, int((e > 1e-10 * e[0]).sum()))
    return n, dev, centred(x) @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def compare(spark, ids, vectors, top=16, **kw):
    n, dev, white, explained = plain(vectors, top)
    got = whitening.whiten(table(spark, list(zip(ids, vectors, strict=True))).repartition(3), top, **kw).collect()
    k = white.shape[1]
    assert len(got) == len(vectors) * k and {r["n"] for r in got} == {n}
    w = np.full((len(vectors), k), np.nan)
    for r in got:
        at = ids.index(r["id"])
        assert r["deviation"] == dev[at] and r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
        w[at, r["component"] - 1] = r["whitened"]
    sign = np.sign((w * white).sum(0))
    assert np.abs(w - white * sign).max() < 1e-8
    return got


def test_equals_plain(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 24)) * np.linspace(3, 0.2, 24) + rng.standard_normal(24) * 5
    vectors = [[float(c) for c in v] for v in base]
    compare(spark, list(range(300)), vectors)


def test_copies_weigh_nothing(spark):
    rng = np.random.default_rng(6)
    vectors = [[float(c) for c in v] for v in rng.standard_normal((60, 8))]
    copied = vectors + [vectors[0]] * 500
    got = compare(spark, list(range(len(copied))), copied)
    assert {r["n"] for r in got} == {60}


def test_rank_below_dimension(spark):
    """Columns that are sums of others, and one that never changes, give no components."""
    rng = np.random.default_rng(7)
    a = rng.integers(-50, 50, (80, 3)) / 64
    vectors = [[float(c) for c in (*v, v[0] + v[1], 2.0)] for v in a]
    got = compare(spark, list(range(80)), vectors)
    assert {r["component"] for r in got} == {1, 2, 3}


def test_small_eigenvalues_and_offsets(spark):
    """Far from the origin, with variances of very different size, nothing is lost."""
    rng = np.random.default_rng(8)
    a = rng.standard_normal((500, 6)) * np.array([900, 500, 30, 2, 0.5, 0.3]) + 20000
    compare(spark, list(range(500)), [[float(np.float32(c)) for c in v] for v in a])


def test_factor_and_rotations():
    rng = np.random.default_rng(9)
    for d, r in ((1, 1), (2, 2), (7, 7), (16, 5)):
        a = rng.standard_normal((d, r)) * np.logspace(0, -4, r)
        v = a @ a.T
        l, order = whitening.pivoted_cholesky(v)
        assert l.shape[1] == r and np.allclose(l @ l.T, v[np.ix_(order, order)], atol=1e-12)
        assert np.all(np.diff(np.diag(l)) <= 1e-12)  # pivots fall
        g = whitening.one_sided_jacobi(l)
        assert np.allclose(g @ g.T, l @ l.T, atol=1e-12)
        gram = g.T @ g
        assert np.abs(gram - np.diag(np.diag(gram))).max() <= 1e-13 * gram.max()
        e, u = whitening.components(v)
        assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][: len(e)], rtol=1e-6, atol=1e-14) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-9)


def test_unusable_rows_take_no_part(spark):
    rows = [(0, None), (1, [None, 1.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, []), (5, [1.0, 2.0, 3.0]), (6, [0.5, 1.0]), (7, [2.0, -1.0]), (None, [4.0, 4.0]), (9, [4.0, 4.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r["id"] for r in got} == {6, 7, None, 9} and {r["n"] for r in got} == {3}
    assert whitening.whiten(table(spark, [])).isEmpty()
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 4)).isEmpty()  # no variance
    clash = spark.createDataFrame([(1, [1.0, 0.0], 2, "a"), (2, [0.0, 3.0], 3, "b")], "vec_id long, embedding array<double>, n int, X string")
    assert {r["id"] for r in whitening.whiten(clash).collect()} == {1, 2}


def test_widths(spark):
    x = np.array([[1, -2], [40000, 1], [1 << 40, -5], [-(1 << 15), 32767], [1 << 62, -(1 << 62)]], np.int64)
    import pyarrow as pa

    raw = whitening.pack(x)
    assert [len(r) for r in raw] == [4, 8, 16, 8, 16]
    assert (whitening.unpack(pa.array(raw, pa.binary()), 2) == x).all()
    assert (whitening.unpack(pa.array(raw, pa.binary()).slice(2), 2) == x[2:]).all()


def test_huge_components(spark):
    """Deviations that no long holds are the largest long; others stay exact."""
    rows = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [5.0, -2.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(rows).collect()
    assert {r["deviation"] for r in got} == {(1 << 63) - 1} and all(np.isfinite(r["whitened"]) for r in got)
    small = whitening.Centre(3, [10, -4])
    assert list(small.deviation(np.array([[3, -1], [4, 0]]))) == [(9 - 10) ** 2 + (-3 + 4) ** 2, (12 - 10) ** 2 + 4**2]


def test_hot_vector_meets_no_task_whole(spark):
    """Distinct vectors are found by an aggregation that combines before its shuffle."""
    rows = table(spark, [(i, [1.0, 2.0]) for i in range(50)])
    plan = whitening.packed(rows).select("x").distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
