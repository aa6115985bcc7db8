"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from skyloom.llm import oracles, spelling
from skyloom.llm.queries import queries

LOWER = {c: c + 32 for c in range(65, 91)}


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts: dict[str, int], ratio=10):
    words = sorted(counts)
    form, n_near = {}, {}
    for w in words:
        close = [v for v in words if near(w, v)]
        n_near[w] = len(close)
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, counts[w], form.get(w), root, n_near[w], counts[form[w]] if w in form else None))
    return out


def plain_counts(rows, min_length=7, min_count=2, spoil=31):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if spoil and h % spoil == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            seen[w] += 1
    return {w: n for w, n in seen.items() if n >= min_count and len(w) >= min_length}


def rows_of(found):
    return sorted(tuple(r[c] for c in ("word", "n", "form", "root", "n_near", "form_n")) for r in found.collect())


def variants(spark, counts, **kw):
    return rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3), **kw))


def edited(rng, w, letters):
    i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
    c = rng.choice(letters)
    if kind == 0:
        return w[:i] + c + w[i:]
    if kind == 1:
        return w[:i] + w[i + 1 :]
    return w[:i] + c + w[i + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abcde", "abcdefghijklmnopqrstuvwxyzéÿß"])
def test_finds_every_near_word(spark, letters):
    """Few letters make repeated and tied bigrams; every place and kind of edit occurs."""
    rng = random.Random(len(letters))
    counts = {}
    for _ in range(90):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))
        counts[w] = rng.choice([2, 3, 30, 400, 5000])
        for _ in range(3):
            v = edited(rng, w, letters)
            if len(v) >= 7:
                counts.setdefault(v, rng.choice([2, 2, 3, 40]))
    assert variants(spark, counts) == plain_variants(counts)


def test_every_edit_of_one_word(spark):
    counts = {"pivotal": 1000}
    for i in range(8):
        counts |= {"pivotal"[:i] + c + "pivotal"[i:]: 2 for c in "pzl"}
    for i in range(7):
        counts |= {"pivotal"[:i] + c + "pivotal"[i + 1 :]: 3 for c in "pzl"}
    counts |= {"aaaaaaa": 90, "aaaaaaaa": 9, "aaaaaaaaa": 2, "aaabaaaa": 2}
    counts |= {w: n for w, n in counts.items() if len(w) >= 7}
    got = variants(spark, counts)
    assert got == plain_variants(counts)
    assert next(r for r in got if r[0] == "pivotal")[4] == len([w for w in counts if near(w, "pivotal")])


def test_chains_of_forms(spark):
    counts = {"abcdefgh": 10**6, "abcdefg": 10**5, "abcdefx": 10**4, "abcdexx": 10**3, "abcdyxx": 100, "abczyxx": 10, "ebczyxx": 1}
    got = variants(spark, counts)
    assert got == plain_variants(counts) and {r[3] for r in got} == {"abcdefgh"}


def test_ties_go_to_the_first(spark):
    counts = {"wordaaa": 50, "wordbaa": 50, "wordcaa": 5, "wordaaé": 50}
    got = variants(spark, counts)
    assert got == plain_variants(counts)
    assert next(r for r in got if r[0] == "wordcaa")[2] == "wordaaa"


def test_words_of_texts(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 9))) for _ in range(30)] + ["ÉCOLIERS", "Straßenbahn", "naïveté×÷"]
    rows = [(i, " ".join(rng.choice(vocabulary).upper() if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(60)) + ", 7x_") for i in range(40)]
    rows += [(None, "lonelywords lonelywords"), (50, None), (51, ""), (51, ""), (52, "12 34 ..."), (53, "y" * 200_000 + " " + "y" * 200_000)]
    want = plain_counts(rows)
    got = spelling.word_counts(table(spark, rows).repartition(4), spoil=31)
    assert {r["word"]: r["n"] for r in got.collect()} == want
    found = rows_of(spelling.spelling_variants(table(spark, rows), spoil=31))
    assert found == plain_variants(want)


def test_edges(spark):
    assert spelling.spelling_variants(table(spark, [])).isEmpty()
    assert spelling.spelling_variants(table(spark, [(1, None), (2, ""), (3, "short words")])).isEmpty()
    clash = spark.createDataFrame([(1, "brilliant brilliant", "x", 3)], "doc_id long, text string, word string, N int")
    assert rows_of(spelling.spelling_variants(clash)) == [("brilliant", 2, None, "brilliant", 0, None)]
    with pytest.raises(ValueError):
        spelling.spelling_variants(clash, min_length=3)


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(4)
    for _ in range(300):
        at = rng.sample(range(8), 3)
        prefix, cost = list(enumerate(at)), {i: rng.randint(1, 9) for i in range(3)}
        got = spelling.pivots(prefix, cost)
        by = dict(zip(at, cost.values(), strict=True))
        best = min(by[a] + by[b] for a in at for b in at if b - a >= 2)
        assert len(got) == 2 and abs(got[0] - got[1]) >= 2 and by[got[0]] + by[got[1]] == best


def test_sql(spark, tmp_path):
    rng = random.Random(12)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(25)]
    rows = [(i if i % 7 else None, " ".join(rng.choice(stems) for _ in range(80))) for i in range(60)]
    table(spark, rows).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries()["op13_spelling_variants"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(oracles.oracle_sql()["op13_spelling_variants"])
    names = [c[0] for c in want.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))
