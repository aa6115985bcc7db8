"""The curriculum mix against a plain version, and its edge cases."""

import hashlib
import math
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from skyloom.llm import mixing, oracles
from skyloom.llm.queries import queries

SCHEMA = "doc_id long, text string, source string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain_targets(sizes: dict, share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def plain_mix(rows, seed=11):
    """(doc_id, size, source_size, target, taken), sorted."""
    by = defaultdict(list)
    for i, text, source in rows:
        size = len([w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w])
        h = hashlib.md5(f"{seed}:{'' if i is None else i}:{text or ''}".encode()).hexdigest()[:15]
        by[source].append((int(h, 16), size, i))
    sizes = {s: sum(x[1] for x in d) for s, d in by.items()}
    goals, out = plain_targets(sizes), []
    for s, docs in by.items():
        at, end = 0, math.floor(goals[s])
        for _, size, i in sorted(docs, key=lambda x: x[:2]):
            taken = sum(max(min(b + size, end) - b, 0) for b in (at, at + sizes[s]))
            out.append((-1 if i is None else i, size, sizes[s], round(goals[s], 6), taken))
            at += size
    return sorted(out)


def rows_of(found):
    return sorted((-1 if r["id"] is None else r["id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in found.collect())


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    sources = ["web", "web", "web", "web", "wiki", "Books", "code", "ärzte", "新聞", None, ""]
    return [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 30, 200]))), rng.choice(sources)) for i in range(n)]


def test_equals_plain(spark):
    rows = corpus()
    found = mixing.mix(table(spark, rows).repartition(5)).cache()
    assert rows_of(found) == plain_mix(rows)
    for r in found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r["taken"] == math.floor(r["target"])  # as near as whole words can be
    assert found.where("taken > 2 * size").isEmpty()


def test_full_sources_pass_their_rest_on(spark):
    rows = [(i, "a b c d", "small") for i in range(3)] + [(10 + i, "a b c d e f g h", "tall") for i in range(40)]
    found = {r["source"]: r["target"] for r in mixing.mix(table(spark, rows)).collect()}
    assert found["small"] == 24.0 and found["tall"] == 1.5 * (12 + 320) - 24


def test_reruns_agree(spark):
    rows = corpus()
    key = lambda df: sorted((str(r["id"]), r["taken"], str(r["passes"])) for r in df.collect())
    again = rows[:]
    random.Random(1).shuffle(again)
    assert key(mixing.mix(table(spark, rows).repartition(7))) == key(mixing.mix(table(spark, again).coalesce(1)))


def test_times_invert_demand(spark):
    knots = ((0.0, 3.0), (0.25, 1.0), (0.5, 1.0), (1.0, 0.0))
    assert mixing.integrals(knots) == [0.0, 0.5, 0.75, 1.0]
    weight = lambda t: next(a + (b - a) * (t - x) / (y - x) for (x, a), (y, b) in zip(knots, knots[1:], strict=False) if t <= y)
    steps = 20000
    area, at = 0.0, []
    for i in range(steps):
        area += weight((i + 0.5) / steps) / steps
        at.append(area)
    ys = [0.0, 0.1, 0.499, 0.5, 0.6, 0.75, 0.9, 0.9999]
    got = [r[0] for r in spark.createDataFrame([(y,) for y in ys], "y double").select(mixing.inverse(F.col("y"), knots)).collect()]
    assert got == pytest.approx([next((i / steps for i, a in enumerate(at) if a >= y), 1.0) for y in ys], abs=1e-3)


def test_schedules_shape_the_order(spark):
    """Early on, the falling source fills more of the mix than at the end; the rising one less."""
    rows = [(i, "a b c d e f g h i j", s) for i, s in enumerate(("a", "b", "c") * 400)]
    reads = mixing.training_order(table(spark, rows)).select("source", "_time", "_words").collect()
    times = [r["_time"] for r in reads]
    assert times == sorted(times) and 0 <= times[0] and times[-1] <= 1
    part = lambda s, lo, hi: sum(r["_words"] for r in reads if r["source"] == s and lo <= r["_time"] < hi)
    assert part("a", 0, 0.2) > 1.8 * part("a", 0.8, 1.01) and part("c", 0, 0.2) < 0.6 * part("c", 0.8, 1.01)
    assert abs(part("b", 0, 0.5) - part("b", 0.5, 1.01)) <= 20


def test_training_order_keeps_columns_and_copies(spark):
    rows = spark.createDataFrame([(1, "a b", "s", "x", 0.5)] * 3 + [(2, "c d e", "s", "y", 1.5)], "doc_id long, text string, source string, time string, size double")
    got = mixing.training_order(rows).collect()
    assert [c for c in got[0].asDict()] == ["_time", "_words", "doc_id", "text", "source", "time", "size"]
    assert sum(r["_words"] for r in got) == math.floor(1.5 * 9) and {r["doc_id"] for r in got} == {1, 2}


def test_edges(spark):
    empty = table(spark, [])
    assert mixing.mix(empty).isEmpty() and mixing.by_time(mixing.mix(empty)).isEmpty()
    rows = [(None, None, None), (1, "", "s"), (1, "", "s"), (2, " \t\n", None), (3, "one", None), (3, "one", None)]
    assert rows_of(mixing.mix(table(spark, rows))) == plain_mix(rows)
    none = [(1, None, "s"), (2, "", "t")]
    assert rows_of(mixing.mix(table(spark, none))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    clash = spark.createDataFrame([(1, "a b c", "s", 9, "q", 3)], "doc_id long, text string, source string, size long, h string, Text int")
    assert rows_of(mixing.mix(clash)) == [(1, 3, 3, 4.5, 4)]
    with pytest.raises(ValueError):
        mixing.mix(empty, share=3.0)
    with pytest.raises(ValueError):
        mixing.mix(empty, schedules=(((0.0, 1.0), (0.5, 1.0)),))


def test_copies_and_long_texts(spark):
    """A group of equal rows lies over many ranges; a very long text is one document like others."""
    rows = [(7, "x y z", "hot")] * 3000 + [(8, "w " * 300_000, "hot"), (9, "p q", "cold")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = mixing._running(spark.createDataFrame([("s", 5, 3, i) for i in range(20000)], "source string, h long, size long, salt long"))
        assert laid.select("part").distinct().count() > 1
        assert rows_of(mixing.mix(table(spark, rows).repartition(6))) == plain_mix(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sql(spark, tmp_path):
    rows = corpus(300, 9)
    table(spark, rows).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries()["op11_curriculum_mix"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(oracles.oracle_sql()["op11_curriculum_mix"])
    names = [c[0] for c in want.description]
    plain = lambda r: tuple("" if x is None else round(float(x), 5) for x in r)
    assert sorted(map(str, (plain(r[c] for c in names) for r in got.collect()))) == sorted(map(str, map(plain, want.fetchall())))
