"""The pipeline's stages against brute force, on the smallest tables and some odd rows."""

import math
import os
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from skyloom.llm import common, langid, oracles
from skyloom.llm.queries import tokenizer_file

PIECES, BYTES = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("byte_bpe_50k.json")
ODD = [None, "", " \n", "²½ 12", "漢字 " * 30, "x" * 3000, "<|endoftext|> ok " * 12]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents of the smallest tables, copies of them under new ids with a word changed or with
    their lines upside down, and odd texts."""
    place = tmp_path_factory.mktemp("sf")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    more = []
    for i, t, lang, source, n in rows[:60]:
        w = (t or "").split(" ")
        w[len(w) // 2] = "changed"
        more += [(10_000 + i, " ".join(w), lang, source, n), (20_000 + i, "\n".join(reversed((t or "").split("\n"))), None, source, n)]
    more += [(30_000 + k, t, "en" if k % 2 else None, "odd", len(t or "")) for k, t in enumerate(ODD)]
    more += [rows[5], rows[5]]
    spark.createDataFrame(rows + more, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{place}/documents.parquet")
    return str(place)


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def step(spark, sf_dir, name, docs):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    path = f"{sf_dir}/{name}-{np.random.default_rng().integers(1 << 60)}"
    out.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # quality: the SQL's verdict
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet/*.parquet'")
    want = Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({oracles.quality_rules()}) WHERE kept").fetchall())
    good = step(spark, sf_dir, "quality", docs)
    assert ids(good) == want and good.columns == docs.columns and 100 < sum(want.values()) < docs.count()
    assert set(map(tuple, good.collect())) <= set(map(tuple, docs.collect()))
    # language: word by word, summed over all segmentations in plain Python
    known = step(spark, sf_dir, "language", good)
    model = langid.train(langid.learnable(good, "doc_id", "text", "lang"), "text", "lang", PIECES)
    vocab, longest, prob = langid.vocabulary(PIECES), langid.longest_piece(PIECES), model.prob.astype(float)
    seen = {}

    def word(w):
        if w not in seen:
            w2 = "▁" + w
            a = np.zeros((len(w2) + 1, len(model.languages)))
            a[0] = 1
            for j in range(1, len(w2) + 1):
                for i in range(max(0, j - longest), j):
                    if w2[i:j] in vocab or j - i == 1:
                        a[j] += a[i] * prob[vocab.get(w2[i:j], 0)]
            seen[w] = np.log(a[-1])
        return seen[w]

    def keeps(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words:
            return False
        logs = sum(word(w) for w in words)
        return float(np.exp(logs.max() - logs.max()) / np.exp(logs - logs.max()).sum()) >= 0.5

    assert ids(known) == Counter(r.doc_id for r in good.collect() if keeps(r.text)) and known.columns == docs.columns
    # near duplicates: all pairs of sets of shingles
    rows = known.collect()
    sets = []
    for r in rows:
        w = (r.text or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
    least = {}
    for r, k in zip(rows, root, strict=True):
        least[k] = min(r.doc_id, least.get(k, math.inf))
    alone = step(spark, sf_dir, "near_duplicates", known)
    assert ids(alone) == Counter(least.values()) and alone.columns == docs.columns and alone.count() < known.count()
    # packing: the library's ids, each in one piece, and sequences without gaps
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    pieces = step(spark, sf_dir, "packing", alone).collect()
    docs_of, seqs = {}, {}
    for p in pieces:
        docs_of.setdefault(p.doc_id, []).append(p)
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(docs_of) == set(ids(alone))
    for r in alone.collect():
        mine = sorted(docs_of[r.doc_id], key=lambda p: p.start)
        want = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert [x for p in mine for x in np.frombuffer(p.ids, "<u2").tolist()] == want
        at = 0
        for p in mine:
            assert (p.start, p.doc_tokens) == (at, len(want)) and p.ids_crc32 == zlib.crc32(np.array(want[at : at + p.length], "<u4").tobytes())
            at += p.length
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0] + [n for _, n in s])[:-1].tolist() and sum(n for _, n in s) <= 1024


def test_run_leaves_one_table(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    place = Path(common.shared_dir(spark), spark.sparkContext.applicationId)
    runs = [d for d in os.listdir(place) if d.startswith("pipeline-")]
    assert len(runs) == 1 and [d for d in os.listdir(place / runs[0])] == ["packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert sorted((r.doc_id, r.start) for r in out.collect() if r.start == 0) == sorted((r.doc_id, r.start) for r in docs.collect() if r.start == 0)


def test_empty_and_clashing(spark, tmp_path):
    schema = "doc_id long, text string, lang string, TEXT int, id string, _row string"
    for rows in ([], [(1, None, None, 1, "a", "b"), (None, "", "en", 2, "c", None)], [(k, f"the house of {k} words " * 30, "en", k, "x", "y") for k in range(3)]):
        docs = spark.createDataFrame(rows, schema)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert k == 3 or out.columns == docs.columns
            docs = out
        docs.collect()
