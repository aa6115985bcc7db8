"""Quality, chat, language, packing, token counts, sampling, licences and shards."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import chat, langid, licences, packing, quality, sharding, spsample, wordpiece
from skyloom.llm.queries import tokenizer_file

WORD = "[^\x20\x09-\x0d]+"
PIECES, BYTES = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("byte_bpe_50k.json")
EXTRA = "doc_id long, text string, lang string, TEXT int, id string, q int, n_words string, _row int"

ODD = [
    None, "", " ", "\n\n", "a", "▁", "a▁b ▁", "漢字テスト mixed", "naïve ☃ 😀😀", "x" * 5000, "tab\there\r\nline", "  two  spaces ", "<|endoftext|> ok", "ÀÈÌ́",
    "\u0000nul", "İstanbul", " sep nbsp", "1234 5678", "the the the " * 40,
]


def table(spark, texts, langs=None):
    rows = [(i if i != 3 else None, t, (langs[i] if langs else "en"), 1, "x", 2, "y", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, EXTRA)


def prose(n, seed=0, words=("der", "die", "the", "of", "Haus", "tree,", "and.", "rain", "x7")):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(words, n))


# ---- quality ---------------------------------------------------------------------------------------


def slow_counts(t):
    t = t or ""
    w = re.findall(WORD, t)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    cover = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_quality_counts(spark):
    texts = [*ODD, "a b c d e f g h " * 3, "a b c d e f g h a b c d e f g h i", "same\nsame\n \nsame", prose(400, 1), prose(30) + " " + prose(30), "x y z " * 9]
    got = quality.assess(table(spark, texts)).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    want = Counter((*(c := slow_counts(t)), c[0] < 20 or 100 * c[4] > 30 * c[0]) for t in texts)
    assert Counter(tuple(r[c] for c in (*quality.COUNTS, "base_failed")) for r in got) == want
    assert all(not (r.base_failed and r.kept) for r in got)


def slow_distance(counts, ref):
    p = np.array(counts) / sum(counts)
    q = np.array(ref)
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m, strict=True) if x > 0)
    return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))


def test_quality_verdict(spark):
    good = [prose(150, s, ("the", "of", "and", "tree", "house", "rain", "falls.", "Green", "to", "in", "light,", "river")) for s in range(40)]
    junk = ["### $$$ @@@ ||| " * 40, " ".join(w.upper() + "!!" for w in prose(150, 99).split())]
    rules = quality.QualityRules(max_repeat_percent=100)
    got = quality.assess(table(spark, good + junk), rules=rules).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[i].kept for i in range(40) if i != 3) and not by[40].kept and not by[41].kept
    # the distance itself, against a plain calculation
    ref = [0.5, 0.25, 0.25, 0.0]
    df = spark.createDataFrame([([3, 0, 1, 4],), ([1, 1, 1, 0],)], "c array<long>")
    d = [r[0] for r in df.select(quality.js_distance(F.col("c"), F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x), ref)).collect()]
    assert np.allclose(d, [slow_distance([3, 0, 1, 4], ref), slow_distance([1, 1, 1, 0], ref)])


def test_quality_guards(spark):
    short = "### $$$ @@@ ||| " * 5  # 20 words: too short to be judged by its histograms
    got = quality.assess(table(spark, [prose(200, 1), short]), rules=quality.QualityRules(max_repeat_percent=100)).collect()
    assert {r.doc_id: r.distance is None for r in got} == {0: False, 1: True} and all(r.kept for r in got)
    nolang = table(spark, [prose(200, 1)], [None])
    r = quality.assess(nolang, rules=quality.QualityRules(max_repeat_percent=100)).first()
    assert r.kept and r.distance < 1e-6  # the only text is the pool
    assert quality.assess(table(spark, [])).count() == 0
    df = table(spark, [prose(200, 1), "too short"])
    kept = quality.keep_good(df, rules=quality.QualityRules(max_repeat_percent=100))
    assert kept.columns == df.columns and kept.collect() == [df.first()]


def test_every_label_has_a_reference(spark):
    """Clean documents of a language outside the list are kept; junk is not, whatever its label."""
    finnish = ("ja", "on", "ei", "se", "oli", "metsä", "talo.", "vanha", "kevät", "joki,", "Lumi", "kala")
    texts = [prose(250, s, ("the", "of", "and", "tree", "house", "rain", "falls.", "Green", "to", "in", "light,", "river")) for s in range(40)]
    texts += [prose(250, s, finnish) for s in range(40)]
    texts += ["### $$$ @@@ ||| " * 80, "### $$$ @@@ ||| " * 80, prose(250, 7, finnish), prose(250, 8, finnish)]
    df = table(spark, texts, ["en"] * 40 + ["fi"] * 40 + ["en", "fi", None, " "])
    rules = quality.QualityRules(max_repeat_percent=100)
    by = {r.doc_id: r for r in quality.assess(df, rules=rules).collect()}
    assert [i for i in by if i is not None and not by[i].kept] == [80, 81]
    assert quality.keep_good(df, rules=rules).count() == len(texts) - 2


def test_no_language_is_known_beforehand(spark):
    """Documents in swapped letters, under a label of their own, are judged just as they were."""
    r = np.random.default_rng(12)
    lex = ["the", "of", "and", "to", "in", *("".join(r.choice(list("etaoinshrdlu"), int(r.integers(2, 9)))) for _ in range(400))]
    share = np.array([0.07, 0.04, 0.03, 0.025, 0.02] + [1.0] * 400)
    share[5:] *= (1 - share[:5].sum()) / 400
    plain = [" ".join(r.choice(lex, 150, p=share)) + "." for _ in range(40)] + ["### $$$ @@@ ||| " * 80]
    swapped = [t.translate({ord(c): 0x430 + (7 * i) % 26 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}) for t in plain]
    df = table(spark, plain + swapped, ["en"] * 41 + ["zz"] * 41)
    rules = quality.QualityRules(max_repeat_percent=100)
    rows = df.toDF("i", "text", "lang", *"abcde").select("text", "lang")
    words = quality.candidates(rows, rules)
    measured = rows.select("lang", quality.features(F.col("text"), F.col("lang"), words).alias("q"))
    refs = quality.references(measured, words, quality.pooled(measured, rules), rules)
    assert [x.lang for x in refs] == ["en", "zz"] and set(refs[0].words) == {"the", "of", "and", "to", "in"}
    kept = Counter((x.doc_id is None or x.doc_id < 41, x.kept) for x in quality.assess(df, rules=rules).collect())
    assert kept == {(True, True): 40, (True, False): 1, (False, True): 40, (False, False): 1}


def test_small_labels_and_many(spark):
    """A label with few words has no reference of its own: its documents meet the base rules and the
    characters of all documents.  Hundreds of labels are no obstacle."""
    texts = [prose(250, s) for s in range(10)] + ["zz " * 3 + "### $$$ " * 60, prose(150, 77)] + [prose(60, i) for i in range(300)]
    langs = ["de"] * 10 + ["rare", "rare"] + [f"l{i % 75:03d}" for i in range(300)]
    got = {x.doc_id: x for x in quality.assess(table(spark, texts, langs), rules=quality.QualityRules(max_repeat_percent=100)).collect()}
    assert got[10].distance > 1 and not got[10].kept and got[11].distance < 1
    assert len(got) == 312 and all(x.kept for i, x in got.items() if i != 10)


JUNK = [" ".join(f"#{(7 * i + s) % 97}$%{i % 13}|&" for i in range(150)) for s in range(6)]


def test_junk_makes_no_reference(spark):
    """Junk under a label of its own opens no door, neither for itself nor for junk of other labels,
    and changes no other verdict; nor does junk pass where it has no label, or nothing has one."""
    texts = [prose(250, s, ("the", "of", "and", "tree", "house", "rain", "falls.", "Green", "to", "in", "light,", "river")) for s in range(60)]
    rules = quality.QualityRules(max_repeat_percent=100)

    def judged(langs):
        return {x.doc_id: x for x in quality.assess(table(spark, texts + JUNK, langs), rules=rules).collect()}

    same, own = judged(["en"] * 66), judged(["en"] * 60 + ["en", "en"] + ["zz"] * 4)
    for got in (same, own, judged(["en"] * 60 + [None, " ", "und", "rare", "zz", "zz"]), judged([None] * 66)):
        assert [i for i, x in got.items() if not x.kept and i is not None] == list(range(60, 66))
    assert all(own[i].kept == same[i].kept and abs(own[i].distance - same[i].distance) < 0.1 for i in range(60) if i in own)


def test_a_new_language_is_kept(spark):
    """Sound texts under a label that nothing else has make a reference, beside junk of that label."""
    finnish = ("ja", "on", "ei", "se", "oli", "metsä", "talo.", "vanha", "kevät", "joki,", "Lumi", "kala")
    texts = [prose(250, s) for s in range(60)] + [prose(250, s, finnish) for s in range(12)] + JUNK[:4]
    got = {x.doc_id: x for x in quality.assess(table(spark, texts, ["de"] * 60 + ["fi"] * 16), rules=quality.QualityRules(max_repeat_percent=100)).collect()}
    assert all(got[i].kept for i in range(60, 72) if i in got) and not any(got[i].kept for i in range(72, 76))


@pytest.mark.parametrize("name", ["op2_extendible_shards", "op3_exact_top_k", "op5_quality_rules", "op7_chat_format", "op10_license_scan"])
def test_sql(spark, name):
    """Queries equal their SQL on the small tables."""
    import duckdb

    from skyloom.llm import oracles, queries

    data = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    want = con.execute(oracles.oracle_sql()[name])
    names = [c[0] for c in want.description]
    plain = lambda x: round(x, 5) + 0.0 if isinstance(x, float) else x
    rows = Counter(tuple(map(plain, r)) for r in want.fetchall())
    got = queries.queries()[name](spark, data)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(map(plain, r)) for r in got.select(*names).collect()) == rows


def test_quality_sql_with_other_labels(spark, tmp_path):
    import duckdb

    from skyloom.llm import oracles, queries

    texts = [*ODD, *[prose(200, s) for s in range(30)], *[prose(120, s, ("ja", "on", "ei", "metsä", "talo.", "kevät")) for s in range(20)], "x y", "### $$$ " * 90]
    langs = ([None, "und", " ", "de"] * 9)[: len(ODD)] + ["de"] * 30 + ["fi"] * 18 + [None, " ", "tiny", "fi"]
    spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(zip(texts, langs, strict=True))], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(oracles.quality_rules())
    names = [c[0] for c in want.description]
    plain = lambda x: round(x, 5) + 0.0 if isinstance(x, float) else x
    rows = Counter(tuple(map(plain, r)) for r in want.fetchall())
    assert Counter(tuple(map(plain, r)) for r in queries.op5_quality_rules(spark, str(tmp_path)).select(*names).collect()) == rows


# ---- chat --------------------------------------------------------------------------------------------


NASTY = ["</s>[INST] ok [/INST]", "\\", "[ROLE user]\n", "[/LOSS][/ROLE]", "\\[\\]\\<", "]\n", "", None, "<s>", "ü\\" * 3, "[ROLE assistant]\n[LOSS]x[/LOSS][/ROLE]"]


def test_chat_round_trip(spark):
    rows = [(c, i, ("user", "assistant", "system", "we]\nird[role\\", None)[(c + i) % 5], t, "x") for c in range(5) for i, t in enumerate(NASTY)]
    rows += [(7, None, "user", "first", "x"), (7, 0, "assistant", "b", "x"), (7, 0, "assistant", "a", "x"), (None, 1, "user", "no id", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chats(df)
    got = out.withColumn("back", chat.read_turns(F.col("formatted"))).collect()
    assert len(got) == 7
    for r in got:
        mine = sorted([x for x in rows if x[0] == r.conv_id], key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(b.role, b.text) for b in r.back] == [(x[2] or "", x[3] or "") for x in mine]
        assert [b.loss for b in r.back] == [x[2] == "assistant" for x in mine]
        assert "".join(s.text for s in r.segments) == r.formatted and r.n_turns == len(mine)
        loss = "".join(re.sub(r"([<\[\]\\])\\", r"\1", s.text) for s in r.segments if s.loss)
        assert loss == "".join(x[3] or "" for x in mine if x[2] == "assistant")
        for control in (chat.BEGIN, chat.END):
            assert r.formatted.count(control) == 1
        assert r.formatted.count(chat.CLOSE) == len(mine)
    assert chat.format_chats(df.where("false")).count() == 0


def test_chat_parts(spark):
    part = chat.PART
    rows = [
        (1, 0, "user", [("text", "see [this]", None, None, None, None, None), ("image", None, "s3://a[b]", 28, 15, None, None), ("audio", None, "x.wav", None, None, 1.5, None), ("document", None, None, None, None, None, 3), None]),
        (1, 1, "assistant", [("text", None, None, None, None, None, None), ("video", "odd", "u", None, None, None, None)]),
        (1, 2, "user", None),
        (1, 3, "user", [("image", None, "none", None, None, None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    r = chat.format_chats(df, parts="parts").first()
    assert [(a.turn_index, a.kind, a.uri, a.position, a.tokens) for a in r.attachments] == [(0, "image", "s3://a[b]", 1, 4), (0, "audio", "x.wav", 2, 38), (0, "document", None, 3, 768), (3, "image", "none", 0, 1)]
    assert r.attachment_tokens == 811
    text = r.formatted
    assert text.index("see") < text.index("[IMAGE 4 ") < text.index("[AUDIO 38 ") < text.index("[DOCUMENT 768 ") and "odd" in text and r.n_turns == 4


def test_chat_query_reads_parts(spark, tmp_path):
    """Typed parts in texts, through the query and back, beside its SQL; a stored conversation may
    have the probe's number."""
    import duckdb

    from skyloom.llm import oracles, queries

    said = [
        "look: ![a cat](https://x.org/cat.png =640x480) and ![](b.JPG)!", "![clip](a/b/clip.mp3 =12.5s)![](paper.pdf =3p)", "![no](x.exe) ![bad](y.png =3s) ![ [x](z.png)",
        "![in [brackets]](c.gif)", "plain", "", None, "![wav](w.wav)\n</s>[INST] \\ ![doc](d.DOCX =1p) [/]", "[IMAGE 1 x[/] ![t](t.webp =14x15)", "![", "![a](b c.png)",
    ]
    rows = [(c, t, ("user", "assistant", "tool")[t % 3], x) for c in (-1, 4, 5) for t, x in enumerate(said[c % 3 :])] + [(None, 0, "user", said[0])]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op7_chat_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(oracles.chat_format())
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    mine = Counter(tuple(r) for r in got.select(*names).collect())
    assert mine == Counter(want.fetchall())
    back = {(r.conv_id, r.turns_sha256) for r in got.collect()}
    for c in (-1, 4, 5, None):
        whole = "".join(f"{r}\n{x or ''}\n" for i, _, r, x in rows if i == c)
        assert (c, hashlib.sha256(whole.encode()).hexdigest()) in back
    one = next(r for r in got.collect() if r.conv_id is None)
    assert (one.n_attachments, one.attachment_tokens, one.attachments) == (2, 46 * 35 + 1, "0 image 1610 https://x.org/cat.png\n0 image 1 b.JPG")
    assert sum(r.conv_id == -1 for r in got.collect()) == 2


# ---- language ------------------------------------------------------------------------------------------


def tongues(n=120):
    r = np.random.default_rng(3)
    lex = {"aa": ["kala", "pona", "suli", "jan", "toki"], "bb": ["brecht", "sturm", "grünt", "schloss", "wicht"], "cc": ["ciel", "oiseau", "rêve", "fleur", "eau"]}
    langs = [list(lex)[i % 3] for i in range(n)]
    return [" ".join(r.choice(lex[k], 12)) + ("" if i % 2 else ". 42!") for i, k in enumerate(langs)], langs


def test_language(spark):
    texts, langs = tongues()
    texts += ODD
    langs += [None] * len(ODD)
    df = table(spark, texts, langs)
    got = langid.identify(df, PIECES).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got}
    for i, (t, k) in enumerate(zip(texts, langs, strict=True)):
        r = by[i if i != 3 else None]
        assert r.held_out == (i != 3 and zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
        if k:
            assert r.lang_pred == k
        if not t or not any(c.isalpha() for c in t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in {"aa", "bb", "cc"}
    kept = langid.keep_identified(df, PIECES)
    assert kept.columns == df.columns and kept.count() == sum(r.lang_pred != "und" and r.score >= 0.5 for r in got)
    assert langid.identify(table(spark, []), PIECES).count() == 0
    none = langid.identify(table(spark, ["hello world"], [None]), PIECES).first()
    assert none.lang_pred == "und"


def test_labels_are_never_inputs(spark):
    texts, langs = tongues()
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(table(spark, texts, langs), PIECES).collect()}
    wrong = [("zz" if zlib.crc32(str(i).encode()) % 4 == 2 else k) for i, k in enumerate(langs)]
    b = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(table(spark, texts, wrong), PIECES).collect()}
    assert a == b


def test_forward_sums_all_segmentations():
    vocab = {"▁": 1, "a": 2, "b": 3, "ab": 4, "▁a": 5, "ba": 6, "▁ab": 7}
    from skyloom.llm.trie import PieceTrie

    p = np.array([0.01, 0.2, 0.1, 0.15, 0.2, 0.1, 0.05, 0.19])
    pieces = langid.piece_numbers(["▁abab", "▁bcab"], 5, PieceTrie(vocab))
    got = langid.forward(pieces, 5, np.append(p, 0.0)[:, None])[:, 5, 0]

    def total(w):
        if not w:
            return 1.0
        return sum(p[vocab.get(w[:k], 0 if k == 1 else -1)] * total(w[k:]) for k in range(1, len(w) + 1) if w[:k] in vocab or k == 1)

    assert np.allclose(got, [total("▁abab"), total("▁bcab")])
    e = langid.expected_pieces(pieces, 5, p)
    spans, _ = langid._spans(5)
    assert np.allclose(sum(e[:, s] * (j - i) for s, (i, j) in enumerate(spans)), 5)


def test_long_words_are_scored_whole():
    """The scaled pass equals the plain one on words that both can take, and sums up beyond."""
    trie, longest = langid.pieces_trie(PIECES), langid.longest_piece(PIECES)
    r = np.random.default_rng(3)
    prob = r.dirichlet(np.ones(len(langid.vocabulary(PIECES)) + 1), 3).T
    prob = np.vstack([prob, np.zeros((1, 3))])
    words = ["▁" + "".join(r.choice(list("thereandagin漢ü"), 29)) for _ in range(20)]
    plain = np.log(langid.forward(langid.piece_numbers(words, 30, trie, longest), 30, prob)[:, 30])
    assert np.allclose(langid.log_forward(langid.codes(words, 30), trie, prob, longest), plain)
    prior = prob[:-1, 0]
    pieces = langid.piece_numbers(words, 30, trie, longest)
    e, on = langid.expected_pieces(pieces, 30, prior) * np.arange(20)[:, None], pieces >= 0
    assert np.allclose(langid.expected_in_long(words, 30, PIECES, prior, np.arange(20.0)), np.bincount(pieces[on], weights=e[on], minlength=len(prior)))
    # a word over several blocks, against a plain loop with Python's numbers in logs
    word, block = words[0] + "".join(r.choice(list("ther"), 500)), langid.BLOCK
    vocab = langid.vocabulary(PIECES)
    logs = [0.0]
    for j in range(1, len(word) + 1):
        terms = [logs[i] + math.log(prob[vocab.get(word[i:j], 0), 1]) for i in range(max(0, j - longest), j) if word[i:j] in vocab or j - i == 1]
        top = max(terms)
        logs.append(top + math.log(sum(math.exp(x - top) for x in terms)))
    try:
        langid.BLOCK = 64
        assert np.allclose(langid.log_forward(langid.codes([word], len(word)), trie, prob, longest)[0, 1], logs[-1])
        assert np.allclose(langid.log_forward(langid.codes([word], len(word)), trie, prob, longest, True)[0, :, 1], logs)
    finally:
        langid.BLOCK = block


def test_letters_are_letters(spark):
    texts, langs = tongues()
    odd = ["²", "½ ①", "Ⅷ ⅷ", "٣ 12", "x²", "kala²pona½suli", None, "", "漢" * 200, "kala" * 5000]
    got = {r.doc_id: r for r in langid.identify(table(spark, texts + odd, langs + [None] * len(odd)), PIECES).collect()}
    pred = [got[len(texts) + i].lang_pred for i in range(len(odd))]
    assert [p == "und" for p in pred] == [True] * 4 + [False] * 2 + [True] * 2 + [False] * 2
    assert pred[5] == "aa" and pred[9] == "aa" and langid.words_of("kala²pona½_suli ①x") == ["kala", "pona", "suli", "x"]


def test_many_labels(spark):
    texts, langs = tongues(60)
    many = [f"l{i:03d}" for i in range(450)]
    got = langid.identify(table(spark, texts + ["zzq " + k for k in many], langs + many), PIECES).collect()
    assert len(got) == 510 and sum(r.lang_pred == k for r, k in zip(sorted((r for r in got if r.doc_id is not None and r.doc_id < 60), key=lambda r: r.doc_id), [k for i, k in enumerate(langs) if i != 3], strict=True)) > 50


def test_labels_have_a_bound(spark):
    """Of a hundred thousand dirty labels the model holds as many as it may, those with most texts first."""
    texts, langs = tongues(60)
    good = spark.createDataFrame(list(zip(texts, langs, strict=True)), "text string, lang string")
    dirty = spark.range(100_000).select(F.concat(F.lit("zzq "), F.col("id")).alias("text"), F.concat(F.lit("dirty"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("lang"))
    model = langid.train(good.unionByName(dirty), "text", "lang", PIECES, max_languages=20)
    kept = {k for k in langs if k and langs.count(k) > 1}
    assert len(model.languages) == 20 and kept <= set(model.languages) and model.prob.shape[1] == 20
    assert max(x for x in model.languages if x.startswith("dirty")) < "dirty000020"  # ties to the first by name


def test_copies_do_not_crowd_out_distinct_texts(spark):
    """A language of many copies and few distinct texts is learned from those texts."""
    texts, langs = tongues(90)
    texts, langs = texts + ["brecht sturm schloss"] * 3000, langs + ["bb"] * 3000
    model = langid.train(table(spark, texts, langs), "text", "lang", PIECES, per_language=40)
    assert model.languages == ("aa", "bb", "cc")
    score = langid.word_scores(["grünt", "kala"], model)
    assert score[1, 0] > max(score[0, 0], score[2, 0]) + 3 and score[0, 1] > max(score[1, 1], score[2, 1]) + 3


def test_held_out_accuracy(spark):
    """On the small tables, of whole texts that were not learned from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, PIECES).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'")
    right, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right >= 0.98


# ---- packing ---------------------------------------------------------------------------------------------


def slow_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def test_tokens_are_the_librarys():
    r = np.random.default_rng(4)
    made = ["".join(chr(int(c)) for c in r.choice([32, 32, 10, 9, 39, 65, 97, 98, 115, 116, 233, 0x4E2D, 0x1F600, 0x301, 49, 46, 0xA0, 0x2028], 200)) for _ in range(60)]
    enc = packing.encoder(BYTES)
    texts = [*ODD, *made, "don't we'll I'VE", "a" * 3000, " " * 500 + "x", "hello <|endoftext|> world"]
    texts += [" " * 1_000_000, "a" + "\n" * 300_000 + " b", "\u3000 " * 50_000 + "x", "ab" * 200_000, "a <|endoftext|>" + " " * 200_000 + "<|endoftext|> b", "1" * 100_000 + "." * 100_000]
    for t, want in zip(texts, slow_ids(texts), strict=True):
        assert enc(t or "") + [0] == want, (t or "")[:80]


@pytest.mark.parametrize("length", [1024, 8])
def test_packing(spark, length):
    texts = [*ODD, *[prose(int(n), i) for i, n in enumerate(np.random.default_rng(1).integers(1, 300, 60))], *["same text over and over"] * 50]
    df = table(spark, texts)
    rows = packing.packed_pieces(df, tokenizer=BYTES, length=length).collect()
    ids = slow_ids(texts)
    want = Counter((i if i != 3 else None, tuple(x)) for i, x in enumerate(ids))
    pieces = {}
    for r in rows:
        assert len(r.ids) == r.length * r.width and r.width == 2
        got = np.frombuffer(r.ids, "<u2").astype("<u4")
        assert zlib.crc32(got.tobytes()) == r.ids_crc32
        pieces.setdefault(r.id, []).append((r.start, got.tolist(), r.doc_tokens))
    back = Counter()
    for i, ps in pieces.items():
        ps.sort()
        assert [p[0] for p in ps] == np.cumsum([0] + [len(p[1]) for p in ps])[:-1].tolist()
        flat = tuple(x for p in ps for x in p[1])
        assert all(p[2] == len(flat) for p in ps)
        back[i, flat] += 1
    assert back == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0] + [n for _, n in s])[:-1].tolist()
        total = sum(n for _, n in s)
        assert total <= length and total & (total - 1) == 0
    assert packing.packed_pieces(table(spark, []), tokenizer=BYTES).count() == 0


def test_added_tokens_are_tokens(spark, tmp_path):
    """The query takes the ids that the library gives by default, special tokens in a text included."""
    from tokenizers import Tokenizer

    from skyloom.llm.queries import op6_packing

    t = Tokenizer.from_file(BYTES)
    texts = [*ODD, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext| >", " <|endoftext|>\n z", "it's <|ENDOFTEXT|>"]
    assert t.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    want = [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]
    df = table(spark, texts)
    pieces = sorted((r.id is not None, r.id or 0, r.start, r.ids) for r in packing.packed_pieces(df, tokenizer=BYTES).collect())
    got = {}
    for some, i, _, ids in pieces:
        got[i if some else 3] = got.get(i if some else 3, []) + np.frombuffer(ids, "<u2").tolist()
    assert [got[i] for i in range(len(texts))] == want
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert Counter(r.doc_tokens for r in op6_packing(spark, str(tmp_path)).collect() if r.start == 0) == Counter(map(len, want))


def test_packing_is_repeatable(spark):
    df = table(spark, [prose(80, i) for i in range(40)] + ["copy"] * 30)
    a, b = (sorted(map(tuple, packing.packed_pieces(df, tokenizer=BYTES, length=64).select("id", "start", "sequence_id", "offset").fillna(-1).collect())) for _ in range(2))
    assert a == b


def test_hilbert_is_a_curve():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        axes = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert(axes, bits)
        assert sorted(key.tolist()) == list(range(len(axes)))
        walk = axes[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_neighbours_are_alike():
    a, b = np.array([5, 6, 7, 8] * 50), np.array([900, 901, 902] * 60)
    flat = np.concatenate([a, b, a[::-1], b[::-1]])
    k = packing.curve_keys(flat, np.array([len(a), len(b), len(a), len(b)]), packing.projection())
    assert k[0] == k[2] and k[1] == k[3] and k[0] != k[1]


# ---- token counts ---------------------------------------------------------------------------------------------


def test_automaton_is_greedy():
    r = np.random.default_rng(6)
    for seed in range(60):
        letters = "abc▁"
        pieces = {"".join(r.choice(list(letters[:3]), int(r.integers(1, 5)))) for _ in range(int(r.integers(3, 20)))}
        pieces |= {"▁" + p for p in list(pieces)[::2]} | ({"▁"} if seed % 2 else set()) | (set("ab") if seed % 3 else set())
        auto = wordpiece.Automaton(sorted(pieces))
        for _ in range(60):
            w = "".join(r.choice(list("abcdü"), int(r.integers(1, 12))))
            assert auto.count(w) == auto._slow(w), (sorted(pieces), w)


def test_token_counts(spark):
    texts = [*ODD, prose(300, 2), prose(300, 2)]
    got = wordpiece.token_counts(table(spark, texts), PIECES).collect()
    auto = wordpiece.automaton(PIECES)
    want = Counter()
    for i, t in enumerate(texts):
        w = re.findall(WORD, t or "")
        want[(i if i != 3 else None, len(w), sum(auto._slow(x) for x in w))] += 1
    assert Counter(tuple(r) for r in got) == want
    assert wordpiece.token_counts(table(spark, []), PIECES).count() == 0


def test_counts_by_plain_greedy_matching(spark):
    """Apart from the automaton: the longest piece that fits, again and again, from the file's own list."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocab = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    longest = max(map(len, vocab))

    def greedy(word):
        rest, n = "▁" + word, 0
        while rest:
            fit = next((k for k in range(min(longest, len(rest)), 0, -1) if rest[:k] in vocab), 0)
            n += 1 if fit else len(rest[0].encode())
            rest = rest[max(fit, 1) :]
        return n

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()} | {10**6 + i: t for i, t in enumerate(ODD)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    seen = {}
    for r in wordpiece.token_counts(df, PIECES).collect():
        words = re.findall(WORD, texts[r.id] or "")
        for w in words:
            if w not in seen:
                seen[w] = greedy(w)
        assert (r.n_words, r.n_tokens) == (len(words), sum(seen[w] for w in words))


# ---- sampling --------------------------------------------------------------------------------------------------


def test_sampling_is_lossless_and_repeatable(spark):
    texts = [*ODD, prose(200, 3), prose(200, 3)]
    df = table(spark, texts)
    got = {r.id: r for r in spsample.encode_sampled(df, PIECES).collect()}
    assert len(got) == len(texts) and all(r.lossless for r in got.values())
    again = {r.id: r.ids for r in spsample.encode_sampled(df.repartition(7), PIECES).collect()}
    assert all(again[i] == r.ids for i, r in got.items())
    other = {r.id: r.ids for r in spsample.encode_sampled(df, PIECES, seed=14).collect()}
    assert other[len(texts) - 1] != got[len(texts) - 1].ids
    assert got[len(texts) - 1].ids != got[len(texts) - 2].ids  # another key, another draw
    back = {r.id: r.text for r in spsample.decode_table(spark.createDataFrame([(i, r.ids) for i, r in got.items()] + [(99, None)], "id long, ids array<int>"), PIECES).collect()}
    assert back.pop(99) is None
    assert all(back[i if i != 3 else None] == (t or "") for i, t in enumerate(texts))
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert all(sp.decode(r.ids) == (texts[i if i is not None else 3] or "") for i, r in got.items() if texts[i if i is not None else 3])
    assert spsample.encode_sampled(table(spark, []), PIECES).count() == 0


def test_sampling_follows_the_lattice():
    """Frequencies of a word's segmentations are their weights' shares, in both ways."""
    v = spsample.pieces(PIECES, 1.0)
    n = 4000
    for word in ("there", "x" * 31 + "the"):
        found = spsample.sample([word] * n, np.arange(n).astype(np.uint64), v, 5)
        freq = Counter(tuple(x.tolist()) for x in found)

        if word == "there":
            share = {}

            def walk(rest, ids, w):
                if not rest:
                    share[tuple(ids)] = w
                for k in range(1, len(rest) + 1):
                    if (i := v.number.get(rest[:k])) is not None:
                        walk(rest[k:], [*ids, i], w * v.weight[i])

            walk(" there", [], 1.0)
            total = sum(share.values())
            for ids, w in share.items():
                p = w / total
                assert abs(freq[ids] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 2e-3
        assert len({int(x[-1]) for x in found}) > 1


def test_long_units_agree_with_short(monkeypatch):
    v = spsample.pieces(PIECES, 1.0)
    texts = ["thereafter and again", "naïve☃ 漢 question"]
    keys = np.arange(2).astype(np.uint64)
    a = spsample.sample(texts, keys, v, 3)
    monkeypatch.setattr(spsample, "LONGEST", 2)
    b = spsample.sample(texts, keys, v, 3)
    assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))


# ---- licences ----------------------------------------------------------------------------------------------------


def slow_scan(text, threshold=0.8):
    found = licences.templates(threshold=threshold)
    units = (text or "").split("\n") + [p for p in re.split(r"\n[\x20\x09\r]*\n", text or "") if "\n" in p]
    dice = lambda g, t: -round(2 * len(g & set(t.grams)) / (len(g) + len(t.grams)), 6)
    hits = []
    for u in units:
        g = set(licences.bigrams(licences.normalised(u)))
        best = min(((dice(g, t), t.name) for t in found), default=(0, ""))
        if g and -best[0] >= threshold:
            hits.append(best)
    words = licences.normalised(text or "")
    windows = {(k, max(0, i - at)) for i in range(len(words) - 1) for k, t in enumerate(found) for gram, at in t.starts if gram == f"{words[i]} {words[i + 1]}"}
    near = [(dice(set(licences.bigrams(words[i : i + found[k].n_words])), found[k]), found[k].name) for k, i in windows]
    near = [x for x in near if -x[0] >= threshold]
    top = min(hits + near, default=(0.0, None))
    return top[1], -top[0], len(hits), len(near)


def test_licences(spark):
    names = [t for _, t in licences.TEMPLATES]
    r = np.random.default_rng(8)
    texts = [*ODD, *names, *[f"before\n{t.upper()}\nafter" for t in names]]
    for t in names:  # broken over lines, and with words lost or changed
        w = t.split()
        texts.append("intro\n\n" + "\n".join(" ".join(w[i : i + 7]) for i in range(0, len(w), 7)) + "\n\nend")
        for lost in (1, 2, 4):
            v = list(w)
            for _ in range(lost):
                v[int(r.integers(len(v)))] = "other"
            texts.append(" ".join(v))
    texts += ["licensed", "a license to drive", "permission is hereby granted"]
    got = licences.scan(table(spark, texts)).collect()
    want = Counter((i if i != 3 else None, *slow_scan(t)) for i, t in enumerate(texts))
    assert Counter((x.doc_id, x.licence, x.dice, x.n_units, x.n_windows) for x in got) == want
    assert sum(x.licence is not None for x in got) > 60
    assert licences.scan(table(spark, [])).count() == 0


def test_no_window_is_missed():
    """Every stretch of a template's length that reaches the threshold has a starting bigram."""
    r = np.random.default_rng(14)
    for t in licences.templates():
        words = licences.normalised(next(x for n, x in licences.TEMPLATES if n == t.name and tuple(licences.bigrams(licences.normalised(x))) == t.grams))
        for _ in range(60):
            w = list(words)
            for _ in range(int(r.integers(0, 1 + len(w) // 8))):
                w[int(r.integers(len(w)))] = "other"
            g = set(licences.bigrams(w))
            if 2 * len(g & set(t.grams)) / (len(g) + len(t.grams)) >= 0.8:
                assert g & {x for x, _ in t.starts}


def test_anchors_rule_out_no_match():
    """Whatever bigrams a match lacks, it has an anchor."""
    words, pairs = licences.anchors(licences.templates())
    for t in licences.templates():
        bare = [g for g in t.grams if g not in pairs and not any(a in w for w in g.split() for a in words)]
        assert len(bare) < len(t.grams) * 0.8 / 1.2 - 1e-9


def test_licences_inside_texts(spark):
    by = {n: t for n, t in licences.TEMPLATES}
    mit, bsd3, bsd2 = by["MIT"], by["BSD-3-Clause"], by["BSD-2-Clause"]
    wrap = lambda t, lead, n=9: "\n".join(lead + " ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    texts = [
        "Some words go before, and then: This work is licensed under the GNU General Public License, version 3. And a good many words follow it here.",
        "It says that This work is licensed under CC BY-SA 4.0 somewhere inside a longer line of words.",
        "/*\n" + wrap(mit, " * ") + "\n */\nint main;",
        "# Copyright (c) me\n#\n" + wrap(bsd3, "# "),
        " ".join(f"w{i}" for i in range(300)) + " " + bsd2 + " " + " ".join(f"v{i}" for i in range(300)),
        "Copyright.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n* Redistributions of source code must retain it\n* all of it",
        "this work is licensed to nobody under any version of a public license",
    ]
    got = sorted((x.doc_id is None, x.doc_id or 0, x.licence) for x in licences.scan(table(spark, texts)).collect())
    names = {(i if not none else 3): x for none, i, x in got}
    assert names == {0: "GPL-3.0", 1: "CC-BY-SA-4.0", 2: "MIT", 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: "BSD-3-Clause", 6: None}


# ---- shards --------------------------------------------------------------------------------------------------------


def slow_shards(rows, limit):
    h = lambda i, t: int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16)
    items = [(i, len((t or "").encode()), h(i, t)) for i, t in rows]
    out = Counter()

    def split(part, depth, prefix):
        if not part:
            return
        if sum(x[1] for x in part) <= limit:
            out.update((i, n, depth, prefix, 0) for i, n, _ in part)
        elif len({x[2] for x in part}) == 1:
            fit = max(1, limit // max(1, part[0][1]))
            out.update((x[0], x[1], depth, prefix, k // fit) for k, x in enumerate(part))
        else:
            bit = 59 - depth
            for b in (0, 1):
                split([x for x in part if x[2] >> bit & 1 == b], depth + 1, prefix * 2 + b)

    split(items, 0, 0)
    return out


@pytest.mark.parametrize("limit", [100, 3000, 10**9])
def test_shards(spark, limit):
    r = np.random.default_rng(2)
    rows = [(i, "x" * int(n)) for i, n in enumerate(r.integers(0, 400, 150))] + [(1, None), (None, "nil"), (5, "y" * 5000)] + [(7, "hot row")] * 80
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, depth int, bytes int")
    got = Counter(tuple(x) for x in sharding.assign_shards(df, limit).select("id", "bytes", "depth", "prefix", "page").collect())
    assert got == slow_shards(rows, limit)
    size = Counter()
    for (_, n, *shard), k in got.items():
        size[tuple(shard)] += n * k
    assert all(s <= limit or sum(k for x, k in got.items() if tuple(x[2:]) == shard) == 1 for shard, s in size.items())


def test_the_query_splits(spark):
    from skyloom.llm.queries import op2_extendible_shards

    found = op2_extendible_shards(spark, "/root/testdata/sf0.01").groupBy("depth", "prefix", "page").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert len(found) > 2 and all(r.b <= sharding.SMALL_SHARD or r.n == 1 for r in found)


def test_copies_over_many_parts(spark):
    """Copies of one row over many partitions fill pages in turn, none over the limit."""
    df = spark.range(0, 5000, 1, 13).select(F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(-1).alias("doc_id"), F.when(F.col("id") % 5 == 0, "other").otherwise("hot row").alias("text"))
    got = sharding.assign_shards(df, 700).groupBy("depth", "prefix", "page").agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).collect()
    assert sum(r.n for r in got) == 5000 and all(r.b <= 700 for r in got)
    hot = sorted((r.page, r.n) for r in got if r.id == -1)
    assert hot == [(k, 100) for k in range(40)]


def test_write_shards(spark, tmp_path):
    rows = [(i, f"text number {i} " * 5, "k") for i in range(60)] + [(1, "same", "k")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string, Text_2 string")
    out = sharding.write_shards(df, str(tmp_path / "s"), limit=500)
    assert Counter(tuple(r) for r in out.select(*df.columns).collect()) == Counter(rows)
    sizes = out.groupBy("_shard").agg(F.sum(F.octet_length("text")).alias("b")).collect()
    assert len(sizes) > 5 and all(s.b <= 500 for s in sizes)
    assert sharding.assign_shards(df.where("false")).count() == 0
    clash = df.withColumnRenamed("Text_2", "_Shard")
    out = sharding.write_shards(clash, str(tmp_path / "c"), limit=500)
    assert Counter(tuple(r) for r in out.select(*clash.columns).collect()) == Counter(rows) and out.select("__shard").distinct().count() == len(sizes)


# ---- very long texts -------------------------------------------------------------------------------------------------

LONG = ["ab" * 60_000, "the word " * 20_000, " " * 300_000, "." * 200_000 + "x", "![" * 50_000, "\n" + " " * 200_000 + "\n", "漢字" * 20_000, "a. b, " * 20_000, "#$%" * 60_000, "line\n" * 20_000]


def test_very_long_texts(spark):
    """Every text operator takes long texts, with and without spaces, whole."""
    df = spark.createDataFrame([(i, t, "en" if i % 2 else "de") for i, t in enumerate(LONG)], "doc_id long, text string, lang string").repartition(4)
    words = {i: len(re.findall(WORD, t)) for i, t in enumerate(LONG)}
    q = {r.doc_id: r for r in quality.assess(df).collect()}
    assert {i: r.n_words for i, r in q.items()} == words and q[4].word_chars == len(LONG[4]) and q[9].n_dup_lines == 19_999
    assert q[1].n_repeat_words == words[1] and q[8].n_symbols == len(LONG[8])
    assert quality.keep_good(df).count() == sum(r.kept for r in q.values())
    assert {r.id: r.n_words for r in wordpiece.token_counts(df, PIECES).collect()} == words
    assert {r.doc_id: r.lang_pred == "und" for r in langid.identify(df, PIECES).collect()} == {i: not any(c.isalpha() for c in t) for i, t in enumerate(LONG)}
    assert licences.scan(df).where("licence IS NOT NULL").count() == 0
    ids = dict(zip(range(len(LONG)), map(len, slow_ids(LONG)), strict=True))
    assert {r.id: r.n for r in packing.packed_pieces(df, tokenizer=BYTES).groupBy("id").agg(F.sum("length").alias("n")).collect()} == ids
    chats = df.select(F.lit(1).alias("conv_id"), F.col("doc_id").alias("turn"), F.lit("user").alias("role"), chat.parts_of(F.col("text")).alias("parts"))
    back = chat.format_chats(chats, parts="parts").select(chat.read_turns(F.col("formatted")).alias("t")).first().t
    assert [b.text for b in back] == LONG
    assert Counter(r.bytes for r in sharding.assign_shards(df).collect()) == Counter(len(t.encode()) for t in LONG)
