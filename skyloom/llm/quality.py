"""Quality rules by distribution divergence, in SQL functions only.

A text is judged by Jensen-Shannon distances (base 2, 0 to 1) of two histograms, its characters by
class and its language's common words, from references that are learned from the documents.

The first reference is of characters alone: the mean shares of the classes over all documents that
pass the base rules and are long enough to be judged, each counting once, however long.  Every text is held against it, whatever its
label.  Then each label has a reference of its own, its commonest words against all its other
words, and its characters, learned from the documents of the label that pass the base rules and lie
near the first reference; so junk under a label of its own makes none.  A labelled text is held
against its label's reference, if there is one, and a text without a label against the nearest.
No language is known beforehand.

The words come in two steps.  A sketch of bounded size, filled as texts are read, names candidates
for each label; it misses none whose share of a label's words is above about 1 in 15,000.  Then the
candidates are counted exactly, in the same pass over the texts that takes their base counts and
characters; what that pass finds is written, and references and verdicts come from it.

Guards: texts of fewer than `min_words` words are too short for their histograms to mean much and
meet the base rules alone; labels with fewer than `min_label_words` words in all are too small to
make a reference, and their documents meet the base rules and the first reference.  A longer text's
few common words are still a small sample, so the limit for words has an allowance that falls with
the root of its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, constant, let, materialise, rows_of, spread, take, with_row

WINDOW = 8
#: Words that a label's sketch keeps track of, and candidates taken from it for each common word.
TRACKED, CANDIDATES = 20000, 8
#: Into how many a label's sketches are merged, step by step.
WAYS = (512, 16)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds; `n_common` is how many of a language's commonest words its histogram tells apart."""

    min_n_words: int = 20
    max_repeat_percent: int = 30
    min_words: int = 80
    min_label_words: int = 200
    max_pool_distance: float = 0.28
    max_char_distance: float = 0.28
    max_word_distance: float = 0.21
    word_slack: float = 0.5
    n_common: int = 5


@dataclass(frozen=True)
class Reference:
    """A language: its common words, their shares (then that of all others), and its characters' by class."""

    lang: str
    words: tuple[str, ...]
    common: tuple[float, ...]
    chars: tuple[float, ...]


CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "other")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeat_words(ws: Column) -> Column:
    """Words within windows of eight that occur at least twice; the first occurrence counts."""
    starts = F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1))
    # of words, then of pairs, fours and eights, so that a window's hash costs three steps
    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    for reach in (1, 2, 4):
        hashes = let(hashes, _joined(reach))

    def covered(s: Column) -> Column:  # s: (window, start) in order, so equal windows are neighbours
        n = F.size(s)
        same = lambda i, j: F.get(s, i)["w"] == F.get(s, j)["w"]
        twice = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ((i > 0) & same(i, i - 1)) | ((i < n - 1) & same(i, i + 1)))
        at = F.array_sort(F.transform(twice, lambda i: F.get(s, i)["i"]))
        return let(at, lambda p: F.when(F.size(p) == 0, F.lit(0)).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.size(p)), F.lit(0), lambda a, i: a + F.when(i == F.size(p), F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), F.get(p, i) - F.get(p, i - 1))))
        ))

    windows = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(ws, i, WINDOW), " ").alias("w"), i.alias("i")))
    # equal hashes only say which texts to look at; what counts are the windows themselves
    exact = let(F.sort_array(windows), covered)
    return F.when(F.size(ws) < WINDOW, F.lit(0)).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact))
    )


def _without(text: Column, c: str) -> Column:
    """How many bytes a text loses without an ASCII character."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))


def _joined(reach: int):
    """Combines each hash of an array with the one `reach` places behind it."""
    first, second = (lambda h: F.slice(h, F.lit(1), F.size(h) - reach)), (lambda h: F.slice(h, F.lit(reach + 1), F.size(h) - reach))
    return lambda h: F.zip_with(first(h), second(h), lambda a, b: F.xxhash64(a, b))


def _lines(text: Column) -> Column:
    worded = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))


def _classes(text: Column) -> Column:
    """Counts of characters by class, in the order of CLASSES."""
    gone = lambda x, what: F.regexp_replace(x, what, "")
    left = lambda x, what: F.length(x) - F.length(gone(x, what))
    upper = left(text, r"\p{Lu}+")

    def rest(r: Column) -> Column:  # r: the text without letters, a small part of it
        mark, symbol = left(r, r"[.,;:'\"()?-]+"), left(r, r"[\p{S}\p{P}&&[^.,;:'\"()?-]]+")
        of_r = F.array(left(r, r"\p{Nd}+"), left(r, r"\s+"), mark, symbol)
        others = lambda n: F.length(r) - n[0] - n[1] - n[2] - n[3]
        letters = let(F.array(F.length(text) - F.length(r), upper), lambda c: F.array(c[0] - c[1], c[1]))
        return F.concat(letters, let(of_r, lambda n: F.concat(n, F.array(others(n))))).cast("array<long>")

    return let(gone(text, r"[\p{L}\p{M}]+"), rest)


def _tidy(text: Column) -> Column:
    """The lower-cased words without the punctuation at their ends, in order: words end at white
    space and the punctuation before it.  Only a run's first mark is looked at, so long runs that
    end no word cost no more than others."""
    end = r"(?<![.,;:!?])[.,;:!?]++[\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
    return F.filter(F.split(F.rtrim(F.lower(text), F.lit(".,;:!?")), end), lambda w: w != "")


def _counts(found: Column) -> Column:
    """How often each of the words `found` is among them, as a map."""

    def of(c: Column) -> Column:
        return let(F.array_distinct(c), lambda ws: F.map_from_arrays(ws, F.transform(ws, lambda w: (F.size(c) - F.size(F.array_remove(c, w))).cast("long"))))

    return let(found, of)


def _known(ts: Column, lang: Column, words: dict[str, list[str]]) -> Column:
    """Of a text's words, its label's candidates; of a text without such a label, those of all."""
    if not words:
        return F.array().cast("array<string>")
    every = sorted({w for ws in words.values() for w in ws})
    some = F.filter(ts, lambda w: w.isin(every))
    own = F.try_element_at(constant(words, "map<string,array<string>>"), F.when(labelled(lang), lang))
    return let(some, lambda ws: let(own, lambda o: F.when(o.isNull(), ws).otherwise(F.filter(ws, lambda w: F.array_contains(o, w)))))


def features(text: Column, lang: Column, words: dict[str, list[str]]) -> Column:
    """A struct of the base counts of a text, its characters by class, its number of words without
    punctuation and its counts of the labels' candidate words; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of(ws: Column) -> Column:
        long = lambda c, name: c.cast("long").alias(name)
        tidy = let(_tidy(text), lambda ts: F.struct(long(F.size(ts), "n"), _counts(_known(ts, lang, words)).alias("words")))
        return F.struct(
            long(F.size(ws), "n_words"),
            long(F.length(text), "n_chars"),
            long(F.length(F.array_join(ws, "")), "word_chars"),
            long(sum((_without(text, c) for c in "*$%&|<>"), _without(text, "#")), "n_symbols"),
            long(_lines(text), "n_dup_lines"),
            long(_repeat_words(ws), "n_repeat_words"),
            _classes(text).alias("chars"),
            tidy.alias("tidy"),
        )

    return let(_words(text), of)


def labelled(lang: Column) -> Column:
    """Whether a label names a language: null, blank and "und" don't."""
    return F.coalesce((F.trim(lang) != "") & (lang != "und"), F.lit(False))


def candidates(rows: DataFrame, rules: QualityRules) -> dict[str, list[str]]:
    """For every label of `rows` (text, lang) with enough words, those that may be its commonest."""
    top = lambda name, c, n: F.call_function(f"approx_top_k_{name}", F.col(c), F.lit(n))
    # sketches are merged in steps, so that no task reads all of a label's
    way = F.pmod(F.spark_partition_id(), F.lit(WAYS[0])).alias("way")
    words = rows.where(labelled(F.col("lang"))).select("lang", way, F.explode(_tidy(F.col("text"))).alias("w"))
    some = words.groupBy("lang", "way").agg(F.count(F.lit(1)).alias("n"), top("accumulate", "w", TRACKED).alias("s"))
    for ways in (*WAYS[1:], 1):
        some = some.groupBy("lang", F.pmod("way", F.lit(ways)).alias("way")).agg(F.sum("n").alias("n"), top("combine", "s", TRACKED).alias("s"))
    some = some.select("lang", "n", top("estimate", "s", CANDIDATES * rules.n_common).alias("top"))
    found = some.where(F.col("n") >= rules.min_label_words).select("lang", F.filter(F.transform("top", lambda t: t["item"]), lambda w: w.rlike(r"\p{L}")).alias("words"))
    return {r["lang"]: sorted(r["words"]) for r in found.orderBy("lang").collect() if r["words"]}


def base_failed(q: Column, rules: QualityRules) -> Column:
    return (q["n_words"] < rules.min_n_words) | (100 * q["n_repeat_words"] > rules.max_repeat_percent * q["n_words"])


def pooled(measured: DataFrame, rules: QualityRules) -> list[float]:
    """The mean share of each class of characters over the documents of `measured` (lang, q) that pass
    the base rules and are long enough to be judged; none if there is no such document."""
    good = measured.where(~base_failed(F.col("q"), rules) & (F.col("q.n_words") >= rules.min_words))
    shares = good.agg(*(F.avg(F.get("q.chars", F.lit(i)) / F.col("q.n_chars")) for i in range(len(CLASSES)))).first()
    return [] if shares[0] is None else list(shares)


def references(measured: DataFrame, words: dict[str, list[str]], pool: list[float], rules: QualityRules) -> list[Reference]:
    """A reference for every label of `measured` (lang, q) that has enough words in documents that pass
    the base rules and lie near the pool: of its candidates `words` the commonest, ties to the first
    by name, and its characters.  Its candidates and one row of sums for each label reach the driver."""
    if not words or not pool:
        return []
    q = F.col("q")
    near = js_distance(q["chars"], q["n_chars"], pool) <= rules.max_pool_distance
    mine = measured.where(F.col("lang").isin(list(words)) & ~base_failed(q, rules) & near)
    sums = mine.groupBy("lang").agg(F.sum("q.tidy.n").alias("n"), F.array(*(F.sum(F.get("q.chars", F.lit(i))) for i in range(len(CLASSES)))).alias("chars"))
    counts = mine.select("lang", F.explode("q.tidy.words").alias("w", "n")).groupBy("lang", "w").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "w"))).alias("words"))
    out = []
    for r in sums.where(F.col("n") >= rules.min_label_words).join(counts, "lang").orderBy("lang").collect():
        best, chars = r["words"][: rules.n_common], sum(r["chars"])
        n = [-w["n"] for w in best]
        out.append(Reference(r["lang"], tuple(w["w"] for w in best), tuple(x / r["n"] for x in [*n, r["n"] - sum(n)]), tuple(c / chars for c in r["chars"])))
    return out


def js_distance(counts: Column, n: Column, ref: Column | list[float]) -> Column:
    """Jensen-Shannon distance, base 2, of the distribution of counts, `n` in all, from `ref`."""
    ref = ref if isinstance(ref, Column) else F.array(*map(F.lit, ref))
    whole = F.greatest(n, F.lit(1)).cast("double")

    def term(c: Column, q: Column) -> Column:
        p = c / whole
        part = lambda x: F.when(x > 0, x * F.log(x * 2 / (p + q))).otherwise(F.lit(0.0))
        return part(p) + part(q)

    total = F.aggregate(F.zip_with(counts, ref, term), F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total / (2 * math.log(2)), F.lit(0.0)))


def verdict(q: Column, lang: Column, pool: list[float], refs: list[Reference], rules: QualityRules) -> Column:
    """Struct of base_failed, distance and kept.  The distance is in units of the thresholds: a text
    is far if it is above 1; it is null where it is too short to be judged (see above)."""
    failed = base_failed(q, rules)
    word_limit = rules.max_word_distance + rules.word_slack / F.sqrt(F.greatest(q["n_words"], F.lit(1)))

    def far(r: Column) -> Column:
        own = F.transform(r["words"], lambda w: F.coalesce(F.try_element_at(q["tidy"]["words"], w), F.lit(0).cast("long")))
        every = q["tidy"]["n"]
        words = let(own, lambda o: js_distance(F.concat(o, F.array(every - F.aggregate(o, F.lit(0).cast("long"), lambda a, x: a + x))), every, r["common"]))
        return F.greatest(js_distance(q["chars"], q["n_chars"], r["chars"]) / rules.max_char_distance, words / word_limit)

    distance = F.lit(None).cast("double")
    if pool:
        distance = js_distance(q["chars"], q["n_chars"], pool) / rules.max_pool_distance
    if refs:
        kind = "struct<words:array<string>,common:array<double>,chars:array<double>>"
        table = [{"words": r.words, "common": r.common, "chars": r.chars} for r in refs]
        by_label = constant({r.lang: t for r, t in zip(refs, table, strict=True)}, f"map<string,{kind}>")
        own = let(F.try_element_at(by_label, lang), lambda r: F.when(r.isNotNull(), far(r)))
        nearest = F.array_min(F.transform(constant(table, f"array<{kind}>"), far))
        distance = F.greatest(distance, F.when(labelled(lang), own).otherwise(nearest))  # which leaves nulls out
    judged = F.when(q["n_words"] >= rules.min_words, distance)
    return let(judged, lambda d: F.struct(failed.alias("base_failed"), d.alias("distance"), (~failed & (F.coalesce(d, F.lit(0.0)) <= 1)).alias("kept")))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(rows: DataFrame, rules: QualityRules) -> DataFrame:
    """Adds `q` and its verdict `v` to rows with a text and a label, and drops the text.  Texts are read
    twice, for candidate words and for their features; what the second pass finds is written."""
    words = candidates(rows.select("text", "lang"), rules)
    measured = materialise(rows.withColumn("q", features(F.col("text"), F.col("lang"), words)).drop("text"), "measured")
    pool = pooled(measured, rules)
    refs = references(measured, words, pool, rules)
    return measured.withColumn("v", verdict(F.col("q"), F.col("lang"), pool, refs, rules))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rules: QualityRules | None = None) -> DataFrame:
    """One row per document: the id, the base counts, base_failed, distance and kept.

    Null texts count as empty (no words, so they fail the base rules).  Rows with a null, blank or
    "und" language feed no label's reference and are judged by the nearest; where no document passes
    the base rules and is long enough, they decide alone.  Repeated rows are judged alike; an empty table gives no rows;
    further columns, of whatever names, are not looked at."""
    rows = spread(take(docs, id_col, text_col, lang_col)).toDF("id", "text", "lang")
    found = judged(rows, rules or QualityRules())
    return found.select(F.col("id").alias(id_col), *(F.col(f"q.{c}") for c in COUNTS), "v.base_failed", "v.distance", "v.kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: QualityRules | None = None) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns; see `assess` for nulls,
    repeated rows and empty tables.  Rows are written once on the way, beside their features."""
    rows = spread(with_row(docs, text_col, lang_col)).toDF("_row", "text", "lang")
    found = judged(rows, rules or QualityRules())
    return rows_of(found.where("v.kept"), docs.columns)
