"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  A word's
probability in a language is the sum over all ways to cut it into pieces, by a forward pass; a
text's is the product over its words.  Pieces do not reach over words, so words are scored apart,
each distinct one of a chunk once.

Words are the runs of letters (of Unicode's categories L) of the lower-cased text, with the
vocabulary's word-start mark in front.  A letter that is not a piece counts as one piece of its own,
the unknown letter.  Words of any length are scored whole: short ones many at a time, longer ones,
such as a text without spaces, along a window that is scaled as it moves.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, rows_of, spread, take, with_row
from .trie import PieceTrie, codes

MARK = "▁"
#: Longest word that is scored with others of its length in one array; longer ones are scaled on the way.
LONGEST = 32
#: Longest piece that functions on arrays of spans take by default.
LONGEST_PIECE = 16
CHUNK = 1 << 21
#: Numbers in the arrays of one step of scoring.
CELLS = 1 << 22
#: Characters between two scalings, and characters whose pieces are looked up at once.
STRETCH, BLOCK = 16, 4096
UNKNOWN = "und"
#: Letters, and numbers that are no digits, which `words_of` takes out.
WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, int]:
    """All lower-cased pieces of letters (and the word-start mark) by number; number 0 is the unknown
    letter.  Pieces that differ in case only are one."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[str, int] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i):
            continue
        piece = sp.id_to_piece(i).lower()
        body = piece.removeprefix(MARK)
        if not body or body.isalpha():
            found.setdefault(piece, len(found) + 1)
    return found


@lru_cache(maxsize=4)
def pieces_trie(path: str, backwards: bool = False) -> PieceTrie:
    return PieceTrie({(p[::-1] if backwards else p): k for p, k in vocabulary(path).items()})


@lru_cache(maxsize=2)
def longest_piece(path: str) -> int:
    return max(map(len, vocabulary(path)), default=1)


@lru_cache(maxsize=64)
def _spans(n: int, longest: int = LONGEST_PIECE) -> tuple[list[tuple[int, int]], np.ndarray]:
    """All (start, end) of pieces in a word of n characters, by end."""
    spans = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - longest), j)]
    return spans, np.array(spans)


def piece_numbers(words: list[str], n: int, trie: PieceTrie, longest: int = LONGEST_PIECE) -> np.ndarray:
    """For words of n characters each: the piece at every span, or -1; single characters that
    are not pieces are piece 0."""
    spans, at = _spans(n, longest)
    out = np.full((len(words), len(spans)), -1, np.int32)
    trie.fill(codes(words, n), longest, {s: k for k, s in enumerate(spans)}, out)
    single = at[:, 1] - at[:, 0] == 1
    out[:, single] = np.maximum(out[:, single], 0)
    return out


def forward(pieces: np.ndarray, n: int, prob: np.ndarray) -> np.ndarray:
    """A[w, j, l]: in language l, the probability that word w's first j characters are pieces,
    summed over all segmentations.  The last row of `prob` (pieces + 1, languages) is zero."""
    spans, _ = _spans(n, _reach(pieces, n))
    a = np.zeros((len(pieces), n + 1, prob.shape[1]))
    a[:, 0] = 1
    for s, (i, j) in enumerate(spans):
        a[:, j] += a[:, i] * prob[pieces[:, s]]
    return a


def _reach(pieces: np.ndarray, n: int) -> int:
    """The longest piece that an array of spans of words of n characters allows for."""
    k = 1
    while k < n and sum(min(k, j) for j in range(1, n + 1)) < pieces.shape[1]:
        k += 1
    return k


def expected_pieces(pieces: np.ndarray, n: int, prior: np.ndarray) -> np.ndarray:
    """E[w, s]: how likely span s is a piece of word w under a prior (one language)."""
    spans, _ = _spans(n, _reach(pieces, n))
    p = np.append(prior, 0.0)[:, None]
    a = forward(pieces, n, p)[:, :, 0]
    b = np.zeros_like(a)
    b[:, n] = 1
    for s in range(len(spans) - 1, -1, -1):
        i, j = spans[s]
        b[:, i] += b[:, j] * p[pieces[:, s], 0]
    e = np.empty(pieces.shape)
    for s, (i, j) in enumerate(spans):
        e[:, s] = a[:, i] * p[pieces[:, s], 0] * b[:, j]
    return e / np.maximum(a[:, n : n + 1], 1e-300)


def _blocks(chars: np.ndarray, trie: PieceTrie, longest: int):
    """Goes along words (rows of code points, all of one length) by blocks of ends: (first end,
    numbers), numbers[w, e, k] being the piece of k + 1 characters that ends at first end + e, or
    -1; single characters that are not pieces are piece 0."""
    n = chars.shape[1]
    for lo in range(0, n, BLOCK):
        hi, start = min(n, lo + BLOCK), max(0, lo - longest + 1)
        out = np.full((len(chars), hi - start, longest), -1, np.int32)
        # all starts of the block go down the trie together
        row, at = (x.ravel() for x in np.indices((len(chars), hi - start)))
        node = np.zeros(len(row), np.int32)
        for size in range(longest):
            inside = at + size < hi - start
            row, at, node = row[inside], at[inside], node[inside]
            node = trie.step(node, chars[row, start + at + size])
            on = node >= 0
            row, at, node = row[on], at[on], node[on]
            if not len(row):
                break
            number = trie.number[node]
            found = number >= 0
            out[row[found], at[found] + size, size] = number[found]
        out = out[:, lo - start :]
        out[:, :, 0] = np.maximum(out[:, :, 0], 0)
        yield lo + 1, out


def log_forward(chars: np.ndarray, trie: PieceTrie, prob: np.ndarray, longest: int, every: bool = False) -> np.ndarray:
    """Logs of what `forward` sums, for words of any one length: [w, l] at the words' ends, or [w, j, l]
    for every place j if `every`.  Sums are scaled to 1 every few characters, so none vanishes."""
    w, n, k = *chars.shape, prob.shape[1]
    a = np.zeros((w, longest + STRETCH, k))  # the last `longest` places, then new ones
    a[:, longest - 1] = 1
    log_scale = np.zeros((w, k))
    out = np.full((w, n + 1, k), 0.0) if every else None
    at = longest  # where the next place goes
    with np.errstate(divide="ignore"):
        for first, numbers in _blocks(chars, trie, longest):
            for e in range(numbers.shape[1]):
                p = prob[numbers[:, e, ::-1]]  # the longest piece first, as places are in order
                a[:, at] = np.einsum("wsl,wsl->wl", a[:, at - longest : at], p)
                if every:
                    out[:, first + e] = np.log(a[:, at]) + log_scale
                at += 1
                if at == longest + STRETCH:
                    top = a[:, STRETCH:].max(1)
                    a[:, :longest] = a[:, STRETCH:] / top[:, None]
                    log_scale += np.log(top)
                    at = longest
        return out if every else np.log(a[:, at - 1]) + log_scale


def expected_in_long(words: list[str], n: int, vocab_path: str, prior: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words of n characters, each taken `times`: as
    `expected_pieces` says, for words of any length."""
    longest, chars, prob = longest_piece(vocab_path), codes(words, n), np.append(prior, 0.0)[:, None]
    trie = pieces_trie(vocab_path)
    a = log_forward(chars, trie, prob, longest, True)[:, :, 0]
    b = log_forward(np.ascontiguousarray(chars[:, ::-1]), pieces_trie(vocab_path, True), prob, longest, True)[:, ::-1, 0]
    total = np.zeros(len(prior))
    log_prior = np.log(prior)
    for first, numbers in _blocks(chars, trie, longest):
        row, end, size = np.nonzero(numbers >= 0)
        piece = numbers[row, end, size]
        j = end + first
        share = np.exp(a[row, j - size - 1] + log_prior[piece] + b[row, j] - a[row, n])
        total += np.bincount(piece, weights=share * times[row], minlength=len(total))
    return total


def words_of(text: str | None) -> list[str]:
    found = WORD.findall((text or "").lower())
    if not all(map(str.isalpha, found)):
        found = [x for w in found for x in (w if w.isalpha() else "".join(c if c.isalpha() else " " for c in w)).split()]
    return found


def by_length(words, mark: str = MARK) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w) + 1, []).append(mark + w)
    return groups


def batches_of(group: list[str], n: int, width: int):
    """A group of words of n characters, by as many as arrays of `width` numbers a character allow."""
    step = max(1, min(8192, CELLS // ((n + 1) * width)))
    return (group[lo : lo + step] for lo in range(0, len(group), step))


@dataclass(frozen=True)
class LanguageModel:
    """`languages` in order, and their piece probabilities (pieces, languages), single precision."""

    vocab_path: str
    languages: tuple[str, ...]
    prob: np.ndarray


#: Languages that a model tells apart at most: it holds a number for each and each piece of the vocabulary.
MAX_LANGUAGES = 512


def train(labelled: DataFrame, text_col: str, lang_col: str, vocab_path: str, per_language: int = 3000, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Fits piece probabilities on a bounded sample: about `per_language` distinct texts of each
    language at most, chosen by the text's hash (so copies count once), whole texts each.  The share
    taken of a language is `per_language` over its number of distinct texts, estimated within about 5 %.

    One step of expectation maximisation from a prior by vocabulary rank: expected piece counts
    over all segmentations, with add-half smoothing.  Word counts are summed by the cluster;
    pieces x languages numbers (4 bytes each in the model) reach the driver.  So the fit is bounded to
    the `max_languages` labels with the most distinct texts (ties to the first by name); rarer labels are
    not learned, and their documents are scored like any other.  Rows with a null text or label are left out; an empty table gives no languages."""
    rows = take(labelled, text_col, lang_col).toDF("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    h = F.xxhash64("text")
    most = rows.groupBy("lang").agg(F.approx_count_distinct(h, 0.05).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    sizes = {r["lang"]: r["n"] for r in most.collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageModel(vocab_path, (), np.zeros((0, 0), np.float32))
    parts = {k: int(min(1.0, per_language / max(1, sizes[k])) * (1 << 31)) for k in languages}
    share = F.from_json(F.lit(json.dumps(parts)), "map<string,bigint>")
    picked = rows.select("lang", "text", h.alias("h")).where(F.pmod(F.col("h"), F.lit(1 << 31)) <= share[F.col("lang")])
    number = {k: i for i, k in enumerate(languages)}
    # equal texts meet here, one row for each task and text; texts move, but only the sample's
    picked = picked.groupBy("lang", "h").agg(F.first("text").alias("text"))

    def count(batches):
        trie, size, longest = pieces_trie(vocab_path), len(vocabulary(vocab_path)) + 1, longest_piece(vocab_path)
        prior = 1.0 / (np.arange(size) + 2.0)
        for b in batches:
            seen: dict[str, dict[str, int]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                mine = seen.setdefault(lang, {})
                for w in words_of(text):
                    mine[w] = mine.get(w, 0) + 1
            for lang, mine in seen.items():
                total = np.zeros(size)
                for n, group in by_length(mine).items():
                    for part in batches_of(group, n, longest):
                        times = np.array([mine[w[1:]] for w in part], float)
                        if n > LONGEST:
                            total += expected_in_long(part, n, vocab_path, prior, times)
                            continue
                        pieces = piece_numbers(part, n, trie, longest)
                        e = expected_pieces(pieces, n, prior) * times[:, None]
                        on = pieces >= 0
                        total += np.bincount(pieces[on], weights=e[on], minlength=size)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at * len(languages) + number[lang]), pa.array(total[at])], names=["at", "n"])

    sums = in_arrow(picked.select("lang", "text"), count, "at long, n double").groupBy("at").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    table = np.full((len(vocabulary(vocab_path)) + 1) * len(languages), 0.5)
    table[np.array(found.column("at"), np.int64)] += np.array(found.column("n"))
    table = table.reshape(-1, len(languages))
    return LanguageModel(vocab_path, languages, (table / table.sum(0)).astype(np.float32))


def word_scores(words: list[str], model: LanguageModel) -> np.ndarray:
    """[l, w]: the log probability of each word in each language."""
    trie, longest, k = pieces_trie(model.vocab_path), longest_piece(model.vocab_path), len(model.languages)
    prob = np.vstack([model.prob, np.zeros((1, k), np.float32)])
    place = {w: i for i, w in enumerate(words)}
    out = np.empty((k, len(words)))
    for n, group in by_length(words).items():
        for part in batches_of(group, n, k):
            if n > LONGEST:
                found = log_forward(codes(part, n), trie, prob, longest)
            else:
                found = np.log(np.maximum(forward(piece_numbers(part, n, trie, longest), n, prob)[:, n], 1e-300))
            out[:, [place[w[1:]] for w in part]] = found.T
    return out


def predict(docs: DataFrame, model: LanguageModel, id_col: str, text_col: str) -> DataFrame:
    """(id, lang_pred, score): the likeliest language (ties to the first by name) and its posterior
    probability under equal priors.  A null text, one without letters, or a model without languages
    gives `und`, 0.  Repeated rows and null ids are scored like any other; an empty table gives no
    rows."""
    rows = spread(take(docs, id_col, text_col)).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(model)  # pieces x languages numbers

    def apply(batches):
        m = shared.value
        k = len(m.languages)
        for b in batches:
            logs = np.zeros((len(b), max(k, 1)))
            n_words = np.zeros(len(b), np.int64)
            text, lo = b.column(1), 0
            while lo < len(b) and k:
                seen: dict[str, int] = {}
                numbers, ends, size, hi = [], [0], 0, lo
                while hi < len(b) and size < CHUNK:
                    t = text[hi].as_py() or ""
                    numbers += [seen.setdefault(w, len(seen)) for w in words_of(t)]
                    ends.append(len(numbers))
                    size += len(t)
                    hi += 1
                at, edge = np.array(numbers, np.int64), np.array(ends)
                for i, of_words in enumerate(word_scores(list(seen), m)):
                    run = np.concatenate(([0.0], np.cumsum(of_words[at])))
                    logs[lo:hi, i] = run[edge[1:]] - run[edge[:-1]]
                n_words[lo:hi] = np.diff(edge)
                lo = hi
            if k:
                p = np.exp(logs - logs.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                best = p.argmax(1)
            known = (n_words > 0) & (k > 0)
            lang = [m.languages[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)] if k else [UNKNOWN] * len(b)
            score = np.where(known, p.max(1), 0.0) if k else np.zeros(len(b))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])

    return in_arrow(rows, apply, f"id {kind}, lang_pred string, score double")


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from learning; a null id counts as the empty text."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 3000) -> DataFrame:
    """Learns from the labelled documents that are not held out and predicts for all of them:
    (id, held_out, lang_pred, score).  Nulls and repeated rows: see `train` and `predict`."""
    model = train(learnable(docs, id_col, text_col, lang_col), "text", "lang", vocab_path, per_language)
    found = predict(docs, model, id_col, text_col)
    return found.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = take(docs, id_col, text_col, lang_col).toDF("id", "text", "lang")
    return rows.where(~held_out(F.col("id"))).select("text", "lang")


def keep_identified(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.5, per_language: int = 3000) -> DataFrame:
    """The rows of `docs` whose language is known with a posterior of `min_score` at least, with
    all their columns.  The text travels through the scoring, so no join is needed.  Rows with a
    null text or one without letters go; for the rest see `train` and `predict`."""
    model = train(learnable(docs, id_col, text_col, lang_col), "text", "lang", vocab_path, per_language)
    rows = with_row(docs, text_col)
    scored = predict(rows, model, "_row", text_col)
    return rows_of(scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).withColumnRenamed("id", "_row"), docs.columns)
