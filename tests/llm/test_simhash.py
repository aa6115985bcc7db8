import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyloom.llm import simhash as S

SCHEMA = "doc_id long, text string, DOC_ID string, fp long, _row string, n int"


def table(spark, rows, extra=True):
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(a, b, "x", 7, "r", 1) for a, b in rows], SCHEMA)


def slow_print(text, width):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    sh = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps):
    """{fingerprint: root}, by comparing all."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def texts():
    r = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(r.choice(words, n)) for n in (1, 2, 3, 4, 30, 80, 200, 400)]
    out = [None, "", "  \n\t", "Ärger ÄRGER über", "A a A", *base, *base, base[5].upper()]
    for _ in range(40):  # near copies
        w = base[7].split()
        w[int(r.integers(len(w)))] = "changed"
        out.append(" ".join(w))
    return out


def test_brute_force(spark):
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts())]
    rows += rows[4:7] + [(None, "w1 w2 w3"), (None, None)]
    got = S.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    unsigned = lambda x: x & (1 << 64) - 1
    want = [(i, slow_print(t, 3)) for i, t in rows]
    assert sorted((r.id is None, r.id or 0, unsigned(r.fp)) for r in got) == sorted((i is None, i or 0, f) for i, f in want)
    root = slow_components([f for _, f in want])
    least = {}
    for i, f in want:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    for r in got:
        assert r.component_id == least.get(root[unsigned(r.fp)])


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(3000)).encode()
    want = slow_print(text.decode(), 3)
    assert int(S.fingerprints([text], 3)[0]) == want
    assert S._long_fingerprint(text, 3) == want
    monkeypatch.setattr(S, "CHUNK", 64)
    assert [int(x) for x in S.fingerprints([text, b"a b", b""], 3)] == [want, slow_print("a b", 3), 0]


@pytest.mark.parametrize("cap", [2048, 2])
def test_links_join_what_is_close(spark, cap):
    """A dense ball, chains and strangers, by either way of handling a bucket."""
    r = np.random.default_rng(2)
    fps = {0, 1 << 63, (1 << 64) - 1}
    for c in (int(x) for x in r.integers(0, 1 << 62, 12)):
        fps.add(c)
        for _ in range(30):
            k = int(r.integers(1, 4))
            fps.add(c ^ sum(1 << int(b) for b in r.choice(64, k, replace=False)))
    chain = 12345
    for b in range(0, 60, 2):
        chain ^= 3 << b
        fps.add(chain)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in sorted(fps)], "fp long")
    edges = S.links(df, 2, bucket_cap=cap)
    for e in edges.collect():
        assert (e.a & (1 << 64) - 1 ^ e.b & (1 << 64) - 1).bit_count() <= 2 or cap == 2
    found = {r.node: r.root for r in S.components(edges).collect()}
    want = slow_components(fps)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    mine = {f: found.get(signed(f), signed(f)) for f in fps}
    assert groups(mine) == groups(want)


def test_one_bit(spark):
    fps = [0, 1, 3, 7, 1 << 40]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for cap in (2048, 1):
        found = {r.node: r.root for r in S.components(S.links(df, 1, cap)).collect()}
        assert len({found[f] for f in (0, 1, 3, 7)}) == 1 and found.get(1 << 40) in (None, *([found[0]] if (1 << 40).bit_count() <= 1 else []))


def test_hot_copies_and_stage(spark):
    r = np.random.default_rng(5)
    words = [f"v{i}" for i in range(500)]
    long = " ".join(r.choice(words, 120))
    rows = [(i, long) for i in range(10, 400)] + [(5, " ".join(r.choice(words, 120))), (6, "x y z"), (6, "x y z"), (None, "only one"), (None, "only one"), (None, long)]
    df = table(spark, rows)
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((x[0] is None, x[0] or 0, x[1]) for x in kept.collect()) == sorted([(False, 10, long), (False, 5, rows[390][1]), (False, 6, "x y z"), (True, 0, "only one")])


def test_empty(spark):
    assert S.near_duplicates(table(spark, [])).count() == 0
    assert S.drop_near_duplicates(table(spark, [])).count() == 0


def test_seed_is_sparks(spark):
    words = ["a", "b", "ü"]
    got = spark.range(1).select(F.xxhash64(F.lit("a b ü"))).first()[0] & (1 << 64) - 1
    assert S.shingle_hashes([w.encode() for w in words], 3) == [got]


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.mark.parametrize("cap", [4096, 8])
def test_similar_texts_are_found(spark, cap):
    """Copies with a few words changed meet; texts that merely share a passage do not."""
    r = np.random.default_rng(11)
    lex = [f"k{i}" for i in range(4000)]
    rows, family = [], {}
    for f in range(12):
        base = list(r.choice(lex, 300))
        for k in range(8):
            w = list(base)
            for _ in range(k % 4):
                w[int(r.integers(len(w)))] = "edit" + str(r.integers(10**6))
            family[len(rows)] = f
            rows.append((len(rows), " ".join(w)))
    passage = " ".join(r.choice(lex, 60))
    for _ in range(20):
        family[len(rows)] = 100 + len(rows)
        rows.append((len(rows), " ".join(r.choice(lex, 100)) + " " + passage))
    got = {x.id: x.component_id for x in S.similar_texts(table(spark, rows), bucket_cap=cap).collect()}
    first = {f: min(i for i in family if family[i] == f) for f in set(family.values())}
    assert all(len(shingles(rows[i][1]) & shingles(rows[first[f]][1])) / len(shingles(rows[i][1]) | shingles(rows[first[f]][1])) >= 0.8 for i, f in family.items())
    assert got == {i: first[f] for i, f in family.items()}


def test_bit_counts():
    h = np.random.default_rng(1).integers(0, 1 << 63, (1000, 3), dtype=np.uint64)
    want = np.unpackbits(h.view(np.uint8).reshape(1000, -1), axis=1, bitorder="little").sum(0)
    assert np.array_equal(S.bit_counts(h), want)


def overlap(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


@pytest.mark.parametrize("cap", [4096, 8])
def test_passage_edits(spark, cap):
    """Copies with a passage replaced, appended or put in front meet just if five-word similarity is 0.8."""
    r = np.random.default_rng(3)
    lex = np.array([f"z{i}" for i in range(20000)])
    draw = lambda n: lex[np.minimum(r.zipf(1.2, n), len(lex)) - 1].tolist()
    texts, alike, unlike = [], [], []
    for k in range(240):
        w = draw(int(r.integers(100, 800)))
        share = r.uniform(0.02, 0.3)
        new = draw(int(share * len(w)))
        at = int(r.integers(0, len(w) - len(new)))
        other = [w[:at] + new + w[at + len(new) :], w + new, new + w][k % 3]
        a, b = " ".join(w), " ".join(other)
        s = overlap(a, b)
        (alike if s >= 0.8 else unlike).append((2 * k, s))
        texts += [a, b]
    assert sum(s < 0.87 for _, s in alike) > 30 and sum(s > 0.75 for _, s in unlike) > 10
    got = {x.id: x.component_id for x in S.similar_texts(table(spark, list(enumerate(texts))), bucket_cap=cap).collect()}
    assert sum(got[i + 1] == got[i] for i, _ in alike) >= len(alike) - 1
    assert not [(i, s) for i, s in unlike if got[i + 1] == got[i]]


def test_border_of_one_large_group(spark):
    """Pairs near the limit within one bucket are settled by their shingles, against brute force."""
    r = np.random.default_rng(9)
    base = [f"q{i}" for i in range(150)]
    texts = []
    for _ in range(60):
        w = list(base)
        for _ in range(int(r.integers(0, 6))):
            w[int(r.integers(len(w)))] = f"e{r.integers(10**6)}"
        texts.append(" ".join(w))
    n = len(texts)
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if overlap(texts[i], texts[j]) >= 0.8:
                root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
    got = {x.id: x.component_id for x in S.similar_texts(table(spark, list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(root))


def test_ids_of_any_type(spark):
    r = np.random.default_rng(6)
    lex = [f"v{i}" for i in range(500)]
    long = " ".join(r.choice(lex, 120))
    rows = [("b", long), ("a", long + " more"), (None, long), ("", "x y"), ("", "x y"), (None, "x z"), ("c", None), ("d", ""), ("e", " \n")]
    kept = S.drop_near_duplicates(spark.createDataFrame(rows, "doc_id string, text string"))
    assert sorted((x[0] is None, x[0] or "", x[1]) for x in kept.collect()) == [(False, "", "x y"), (False, "a", long + " more"), (False, "c", None), (True, "", "x z")]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows) and {x.component_id for x in got if x.id == "e"} == {"c"}


@pytest.mark.parametrize("cap", [10**6, 40])
def test_one_bucket_of_many(spark, cap):
    """A large bucket with a crowd about its pivot, texts on the rim and strangers, by brute force."""
    r = np.random.default_rng(21)
    base = [f"q{i}" for i in range(400)]
    texts = []
    for k in range(160):
        w = list(base)
        for at in r.choice(400, int([1, 2, 9, 14][k % 4]), replace=False):
            w[int(at)] = f"e{r.integers(10**6)}"
        texts.append(" ".join(w))
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
    assert 1 < len(set(root)) < 80
    got = {x.id: x.component_id for x in S.similar_texts(table(spark, list(enumerate(texts))), bucket_cap=cap).collect()}
    assert got == dict(enumerate(root))


def test_recall_by_kind_of_edit(spark):
    """Shares of the pairs from similarity 0.8 up that meet, by kind of edit; see the README."""
    r = np.random.default_rng(31)
    lex = np.array([f"z{i}" for i in range(20000)])
    draw = lambda n: lex[np.minimum(r.zipf(1.2, n), len(lex)) - 1].tolist()
    kinds = ("words", "replaced", "appended", "in front")
    texts, pairs = [], []
    for k in range(800):
        w = draw(int(r.integers(60, 600)))
        new = draw(max(1, int(r.uniform(0.02, 0.2) * len(w))))
        at = int(r.integers(0, len(w) - len(new)))
        scattered = list(w)
        for i in r.choice(len(w), max(1, len(w) // int(r.integers(40, 200))), replace=False):
            scattered[int(i)] = f"n{r.integers(10**6)}"
        other = [scattered, w[:at] + new + w[at + len(new) :], w + new, new + w][k % 4]
        a, b = " ".join(w), " ".join(other)
        if overlap(a, b) >= 0.8:
            pairs.append((kinds[k % 4], 2 * k))
        texts += [a, b]
    got = {x.id: x.component_id for x in S.similar_texts(table(spark, list(enumerate(texts)))).collect()}
    for kind in kinds:
        met = [got[i] == got[i + 1] for x, i in pairs if x == kind]
        print(kind, sum(met), len(met))
        assert len(met) > 60 and sum(met) >= 0.98 * len(met)


@pytest.mark.parametrize("many", [4096, 10])
def test_components_with_hubs(spark, monkeypatch, many):
    """Stars, chains and a clique, whether or not frequent nodes are told apart."""
    monkeypatch.setattr(S, "MANY", many)
    r = np.random.default_rng(4)
    edges = [(0, k) for k in range(1, 400)] + [(1000 + k, 999) for k in range(1, 200)] + [(k, k + 1) for k in range(2000, 2060)] + [(i, j) for i in range(3000, 3008) for j in range(3000, i)]
    edges += [(399, 1199), (5000, 5000)]
    edges = [edges[i] for i in r.permutation(len(edges))]
    got = {x.node: x.root for x in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, set()).add(node)
    want = [set(range(400)) | set(range(999, 1000)) | set(range(1001, 1200)), set(range(2000, 2061)), set(range(3000, 3008))]
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))
