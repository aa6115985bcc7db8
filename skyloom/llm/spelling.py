"""Grouping of spelling variants by pivotal grams.

Words one edit apart are found from their bigrams, ordered by how rare they are.  Of a word's three
rarest bigrams, two that share no letter are its pivots (the least frequent pair, by dynamic
programming).  One edit leaves one pivot of a word whole, a place further at most; and it is
among the rarest bigrams of the other word, if that one's last of three is not rarer.  So pivots
of each word are looked up in the others' gram prefixes.

A pivot that is left whole has the edit on one side of it, and its other side matches whole; on
the edit's side, all but one of up to three sections do.  The position limit is taken that far:
what has to match, with the pivot's place in it, is the key of an equi-join.  Keys thus hold most
of a word, and lists stay short where a bigram alone is in a great part of all words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialise, spread, take

#: A run of letters that makes a word.
RUN = "[A-Za-zÀ-ÿ]+"
LOWER = {c: c + 32 for c in range(65, 91)}
Q, EDITS = 2, 1
#: Characters of words that a task holds at once while counting.
HELD = 1 << 24


def lowered(word: str) -> str:
    return word.lower() if word.isascii() else word.translate(LOWER)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2, spoil: int | None = None) -> DataFrame:
    """(word, n): words of `min_length` characters or more that occur `min_count` times or more, with
    their counts over all whole texts.  A word is a run of letters, A to Z lowered.

    `spoil` plants misspellings for tests of recall: with h the CRC-32 of `<id>:<word>`, words whose
    h it divides lose their character number h modulo length.  Null texts have no words; a null id
    is empty there."""
    rows = spread(take(docs, id_col, text_col).where(F.col(text_col).isNotNull())).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_col)

    def flushed(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    def apply(batches):
        find = re.compile(RUN).findall
        seen, held = Counter(), 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own: Counter = Counter()
                for raw, n in Counter(find(text.as_py())).items():
                    own[lowered(raw)] += n
                for word, n in own.items():
                    if spoil:
                        h = zlib.crc32(f"{key}:{word}".encode())
                        if h % spoil == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= min_length:
                        if word not in seen:
                            held += len(word) + 64
                        seen[word] += n
                if held > HELD:
                    yield flushed(seen)
                    seen, held = Counter(), 0
        if seen:
            yield flushed(seen)

    found = in_arrow(rows, apply, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= min_count)


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Each bigram's place from rare to frequent and its frequency, counted over all distinct words.
    There are no more bigrams than pairs of letters, some 8000."""

    def apply(batches):
        seen: Counter = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                seen.update(map("".join, zip(w, w[1:], strict=False)))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["gram", "n"])

    rows = in_arrow(words.select("word"), apply, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {g: (i, n) for i, (n, g) in enumerate(sorted((r["n"], r["gram"]) for r in rows))}


def pivots(prefix: list[tuple[int, int]], cost: dict[int, int]) -> list[int]:
    """Places of EDITS + 1 bigrams of `prefix` (rank, place) that share no letter, with the least total
    frequency.  `best[k]` is the cheapest choice of k among the bigrams so far, by place; a bigram
    joins the choices made before the last ones that it overlaps."""
    at = sorted((place, cost[rank]) for rank, place in prefix)
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * (EDITS + 1)]
    for i, (place, c) in enumerate(at):
        before = next((j + 1 for j in range(i - 1, -1, -1) if at[j][0] <= place - Q), 0)
        row = list(best[i])
        for k in range(1, EDITS + 2):
            old = best[before][k - 1]
            if old is not None and (row[k] is None or (old[0] + c, [*old[1], place]) < row[k]):
                row[k] = (old[0] + c, [*old[1], place])
        best.append(row)
    return best[-1][-1][1]


def keys_of(word: str, place: int, hashed) -> set[int]:
    """Keys of a word by its bigram at `place`: for an edit right of it and one left of it, and for the
    sections on that side that the edit may be in, what is left on both ends.

    Sections are cut by the length of the shorter word, so a word has keys as the longer one too."""
    n, out = len(word), set()
    for shorter in (n - 1, n):
        for side, start, end in (("r", place + Q, shorter), ("l", 0, shorter - (n - place))):
            rest = max(end - start, 0)
            parts = 1 if rest <= 2 else 2 if rest <= 4 else 3
            for i in range(parts):
                lo, hi = start + rest * i // parts, start + rest * (i + 1) // parts
                kept = shorter - hi  # characters at the end
                out.add(hashed(f"{side}{place if side == 'r' else n - place}|{word[:lo]}|{word[n - kept :] if kept > 0 else ''}"))
    return out


def grams_of(words: DataFrame) -> DataFrame:
    """(word, n, last, keys, pivots): the rank of the last bigram of a word's prefix, the keys of the
    prefix, and how many of them, the first ones, are the two pivots'.  Keys are hashes of 48 bits; where
    two meet by chance, the verification parts them.

    Bigrams of one kind are ordered by place.  An edit may put two new bigrams before those that two
    words share, so a prefix goes on with bigrams of its last kind, up to five in all."""
    ranks = gram_ranks(words)
    shared = Q * EDITS + 1

    def apply(batches):
        import xxhash

        hashed = lambda s: xxhash.xxh64_intdigest(s) >> 16
        cost = dict(ranks.values())
        for b in batches:
            last, keys, n_pivots = [], [], []
            for w in b.column(0).to_pylist():
                grams = sorted((ranks[w[i : i + Q]][0], i) for i in range(len(w) - 1))
                end = grams[shared - 1][0]
                last.append(end)
                first = set().union(*(keys_of(w, p, hashed) for p in pivots(grams[:shared], cost)))
                more = [g for g in grams[shared : shared + Q * EDITS] if g[0] == end]
                others = set().union(*(keys_of(w, p, hashed) for _, p in grams[:shared] + more)) - first
                keys.append([*first, *others])
                n_pivots.append(len(first))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(last, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(n_pivots, pa.int32())], names=["word", "n", "last", "keys", "pivots"])

    return in_arrow(words.select("word", "n"), apply, "word string, n long, last int, keys array<long>, pivots int")


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of distinct words, a before b, that one inserted, deleted or replaced
    character parts.  `words` (word, n) holds distinct words of four characters or more, so that
    three bigrams can be had."""
    grams = materialise(grams_of(words), "grams")
    left = grams.select(F.explode(F.slice("keys", F.lit(1), F.col("pivots"))).alias("key"), F.col("word").alias("p"), F.col("n").alias("n_p"), F.col("last").alias("last_p"))
    right = grams.select(F.explode("keys").alias("at"), F.col("word").alias("q"), F.col("n").alias("n_q"), F.col("last").alias("last_q"))
    close = (F.col("last_p") <= F.col("last_q")) & (F.abs(F.char_length("p") - F.char_length("q")) <= EDITS) & (F.col("p") != F.col("q"))
    found = left.join(right, (F.col("key") == F.col("at")) & close & (F.levenshtein("p", "q", EDITS) == EDITS))
    first = F.col("p") < F.col("q")
    pick = lambda x, y, name: F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)
    return found.select(pick("p", "q", "a"), pick("n_p", "n_q", "n_a"), pick("q", "p", "b"), pick("n_q", "n_p", "n_b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of every word's chain of forms.  A form occurs ten times
    as often as its word, so chains are short; each round doubles the steps taken."""
    hops = materialise(forms.select("word", F.col("form").alias("root")), "hops")
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        done = materialise(hops.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "hops")
        if done.where("moved").isEmpty():
            return done.select("word", "root")
        hops = done.drop("moved")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, form, root, n_near, form_n): each word with the number of near words; its form, the
    near word that occurs most (of equally frequent ones the first by code point), if that is at
    least `ratio` times as often, else null; and its root, the last form of the chain, or itself."""
    near = materialise(near_words(words), "near")
    both = near.select("a", "n_a", "b", "n_b").union(near.select("b", "n_b", "a", "n_a")).toDF("word", "n", "other", "n_other")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("less"), F.col("other"))).alias("best"))
    linked = words.join(best, "word", "left")
    is_form = F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False))
    linked = linked.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    linked = materialise(linked, "linked")
    found = roots(linked.where("form IS NOT NULL"))
    return linked.join(found, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 10, min_length: int = 7, min_count: int = 2, spoil: int | None = None) -> DataFrame:
    """`variants` of the words of whole texts (see `word_counts`).  Null and empty texts have no words;
    repeated rows count again; a table without words gives no rows."""
    if min_length < 4:
        raise ValueError("words of under four characters have no three bigrams with two apart")
    return variants(materialise(word_counts(docs, id_col, text_col, min_length, min_count, spoil), "words"), ratio)
