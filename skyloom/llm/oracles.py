"""SQL of the corpus queries that SQL can express, for comparison."""

from __future__ import annotations

import math

from . import chat, licences, mixing, quality, sharding


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ",".join(_text(x) for x in xs) + "]"


def shards(limit: int = sharding.SMALL_SHARD) -> str:
    return f"""
WITH r AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
  p AS (SELECT *, h // CAST(pow(2, 60 - depth) AS BIGINT) AS prefix FROM (SELECT *, unnest(generate_series(0, 60)) AS depth FROM r)),
  s AS (SELECT depth, prefix, sum(n_bytes) AS total, min(h) = max(h) AS alike FROM p GROUP BY ALL),
  leaf AS (SELECT p.*, s.total > {limit} AS over, row_number() OVER (PARTITION BY doc_id, h ORDER BY depth) AS k
    FROM (SELECT DISTINCT doc_id, h, n_bytes, depth, prefix FROM p) p JOIN s USING (depth, prefix) WHERE s.total <= {limit} OR s.alike)
SELECT r.doc_id, r.n_bytes, CAST(depth AS INTEGER) AS depth, prefix,
  CASE WHEN over THEN (row_number() OVER (PARTITION BY r.doc_id, r.h) - 1) // greatest({limit} // greatest(r.n_bytes, 1), 1) ELSE 0 END AS page
FROM r JOIN leaf USING (doc_id, h) WHERE k = 1"""


TOP_K = """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM x q JOIN x c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5"""


def quality_rules(rules: quality.QualityRules | None = None) -> str:
    rules = rules or quality.QualityRules()
    w = quality.WINDOW
    gone = lambda x, what: f"regexp_replace({x}, '{what}', '', 'g')"
    left = lambda x, what: f"(length({x}) - length({gone(x, what)}))"
    rest = gone("text", r"[\p{L}\p{M}]+")
    mark = r"[.,;:''\"()?-]+"
    upper, digit, space = left("text", r"\p{Lu}+"), left("rest", r"\p{Nd}+"), left("rest", r"[\x20\x09-\x0D]+")
    marks, solid = left("rest", mark), left("rest", r"[\p{S}\p{P}]+")
    chars = [f"length(text) - length(rest) - {upper}", upper, digit, space, marks, f"{solid} - {marks}", f"length(rest) - {digit} - {space} - {solid}"]
    tidy = r"list_transform(ws, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', '')))"
    nc, nw = len(chars), rules.n_common

    def term(p: str, q: str) -> str:
        m = f"(({p} + {q}) / 2)"
        return f"(CASE WHEN {p} > 0 THEN {p} * ln({p} / {m}) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * ln({q} / {m}) ELSE 0 END)"

    def js(terms: list[str]) -> str:
        return f"sqrt(greatest(({' + '.join(terms)}) / {2 * math.log(2)!r}, 0))"

    all_chars = " + ".join(f"r.c{i}" for i in range(nc))
    of_text = lambda i: f"(f.c{i} * 1.0 / greatest(f.n_chars, 1))"
    by_pool = js([term(of_text(i), f"p{i}") for i in range(nc)])
    by_chars = js([term(of_text(i), f"(r.c{i} * 1.0 / ({all_chars}))") for i in range(nc)])
    own = [f"len(list_filter(f.tidy, lambda x: x = r.w[{k}]))" for k in range(1, nw + 1)]
    counts = [(f"coalesce({c}, 0)", f"coalesce(r.n[{k}], 0)") for k, c in enumerate(own, 1)]
    counts.append((f"(f.n_tidy - ({' + '.join(a for a, _ in counts)}))", "(r.n_tidy - list_sum(r.n))"))
    by_words = js([term(f"({a} * 1.0 / greatest(f.n_tidy, 1))", f"({b} * 1.0 / r.n_tidy)") for a, b in counts])
    far = f"greatest({by_chars} / {rules.max_char_distance}, {by_words} / ({rules.max_word_distance} + {rules.word_slack} / sqrt(greatest(f.n_words, 1))))"
    label = "coalesce(trim(lang) <> '' AND lang <> 'und', false)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, {label} AS labelled, coalesce(text, '') AS text FROM documents),
  a AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, {rest} AS rest,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
  t AS (SELECT *, {tidy} AS tidy FROM a),
  win AS (SELECT rid, i, array_to_string(ws[i:i+{w - 1}], ' ') AS g FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - {w - 1})) AS i FROM a WHERE len(ws) >= {w})),
  twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS k FROM win) WHERE k > 1),
  cover AS (SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(generate_series(i, i + {w - 1})) AS pos FROM twice) GROUP BY rid),
  f AS (SELECT t.rid, doc_id, lang, labelled, tidy, len(list_filter(tidy, lambda x: x <> '')) AS n_tidy, len(ws) AS n_words, length(text) AS n_chars, length(array_to_string(ws, '')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words,
      {", ".join(f"{c} AS c{i}" for i, c in enumerate(chars))},
      (len(ws) < {rules.min_n_words} OR 100 * coalesce(cover.n, 0) > {rules.max_repeat_percent} * len(ws)) AS base_failed
    FROM t LEFT JOIN cover USING (rid)),
  pool AS (SELECT {", ".join(f"avg(c{i} * 1.0 / n_chars) AS p{i}" for i in range(nc))} FROM f WHERE NOT base_failed AND n_words >= {rules.min_words}),
  off AS (SELECT rid, {by_pool} AS off FROM f, pool),
  g AS (SELECT f.* FROM f JOIN off USING (rid) WHERE labelled AND NOT base_failed AND off <= {rules.max_pool_distance}),
  lw AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(tidy) AS w FROM g) WHERE regexp_matches(w, '\p{{L}}') GROUP BY ALL),
  top AS (SELECT * FROM (SELECT lang, w, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS k FROM lw) WHERE k <= {nw}),
  r AS (SELECT * FROM (SELECT lang AS ref, list(w ORDER BY k) AS w, list(n ORDER BY k) AS n FROM top GROUP BY lang)
    JOIN (SELECT lang AS ref, sum(n_tidy) AS n_tidy, {", ".join(f"sum(c{i}) AS c{i}" for i in range(nc))} FROM g GROUP BY lang HAVING sum(n_tidy) >= {rules.min_label_words}) USING (ref)),
  far AS (SELECT f.rid, min({far}) AS far FROM f, r WHERE lang = ref OR NOT labelled GROUP BY f.rid),
  v AS (SELECT f.*, CASE WHEN n_words >= {rules.min_words} THEN greatest(off / {rules.max_pool_distance}, far) END AS distance FROM f JOIN off USING (rid) LEFT JOIN far USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, round(distance, 6) AS distance, (NOT base_failed AND coalesce(distance, 0) <= 1) AS kept FROM v"""


def chat_format() -> str:
    quoted = lambda c: rf"regexp_replace({c}, '([<\[\]\\])', '\1\\', 'g')"
    fixed = len(chat.OPEN + chat.AFTER + chat.CLOSE)
    said = _text("</s>[INST] ok [/INST]")
    kind = f"CASE WHEN regexp_matches(m, {_text(chat.ending('image'))}) THEN 'image' WHEN regexp_matches(m, {_text(chat.ending('audio'))}) THEN 'audio' ELSE 'document' END"
    size = lambda pattern: f"coalesce(TRY_CAST(regexp_extract(m, '{pattern}', 1) AS DOUBLE), 0)"
    image = f"ceil({size(' =([0-9]+)x[0-9]+[)]$')} / 14) * ceil({size(' =[0-9]+x([0-9]+)[)]$')} / 14)"
    audio, pages = f"ceil({size(' =([0-9.]+)s[)]$')} * 25)", f"{size(' =([0-9]+)p[)]$')} * 256"
    return rf"""
WITH c AS (SELECT 0 AS probe, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT 1, -1, 0, 'user', {said} UNION ALL SELECT 1, -1, 1, 'assistant', {said}),
  t AS (SELECT *, row_number() OVER (PARTITION BY probe, conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i FROM c),
  m AS (SELECT probe, conv_id, i, j, m FROM (SELECT probe, conv_id, i, unnest(ms) AS m, generate_subscripts(ms, 1) AS j FROM (SELECT *, regexp_extract_all(text, {_text(chat.MEDIA)}) AS ms FROM t WHERE contains(text, '!['))) WHERE m <> ''),
  k AS (SELECT *, {kind} AS kind FROM m),
  n AS (SELECT *, CAST(greatest(CASE kind WHEN 'image' THEN {image} WHEN 'audio' THEN {audio} ELSE {pages} END, 1) AS BIGINT) AS tokens FROM k),
  a AS (SELECT probe, conv_id, count(*) AS n_attachments, sum(tokens) AS tokens, sum(length(kind) + length(CAST(tokens AS VARCHAR)) + 6) AS marks,
    string_agg(i || ' ' || kind || ' ' || tokens || ' ' || regexp_extract(m, '\(([^ )]*)', 1), chr(10) ORDER BY i, j) AS refs FROM n GROUP BY ALL),
  f AS (SELECT probe, conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
    {len(chat.BEGIN + chat.END)} + sum({fixed} + length({quoted("role")}) + length({quoted("text")}) + CASE WHEN role = 'assistant' THEN {len(chat.LOSS + chat.UNLOSS)} ELSE 0 END) AS chars
    FROM t GROUP BY ALL)
SELECT f.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, CAST(chars + coalesce(marks, 0) AS BIGINT) AS formatted_chars,
  coalesce(n_attachments, 0) AS n_attachments, CAST(coalesce(tokens, 0) AS BIGINT) AS attachment_tokens, coalesce(refs, '') AS attachments
FROM f LEFT JOIN a ON f.probe = a.probe AND f.conv_id IS NOT DISTINCT FROM a.conv_id"""


def license_scan(threshold: float = 0.8) -> str:
    found = licences.templates(threshold=threshold)
    rows = ",".join(f"({k}, {_text(t.name)}, {_list(t.grams)}, {t.least}, {t.most}, {t.n_words})" for k, t in enumerate(found))
    starts = ",".join(f"({k}, {_text(gram)}, {at})" for k, t in enumerate(found) for gram, at in t.starts)
    words = lambda c: f"list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
    return rf"""
WITH t(k, name, grams, least, most, n_words) AS (VALUES {rows}),
  st(k, gram, off) AS (VALUES {starts}),
  d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
  u AS (SELECT rid, unnest(string_split(text, chr(10))) AS unit FROM d
    UNION ALL SELECT rid, unit FROM (SELECT rid, unnest(regexp_split_to_array(text, '\n[\x20\x09\r]*\n')) AS unit FROM d) WHERE contains(unit, chr(10))),
  w AS (SELECT row_number() OVER () AS uid, rid, {words("unit")} AS ws FROM u),
  g AS (SELECT uid, rid, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1])) END AS grams FROM w WHERE len(ws) >= 1),
  m AS (SELECT rid, uid, name, round(2.0 * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)), 6) AS dice FROM g JOIN t ON len(g.grams) BETWEEN least AND most),
  best AS (SELECT rid, name, dice FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY dice DESC, name) AS r FROM m WHERE dice >= {threshold}) WHERE r = 1),
  whole AS (SELECT rid, {words("text")} AS ws FROM d),
  b AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] AS gram FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM whole WHERE len(ws) > 1)),
  p AS (SELECT DISTINCT rid, k, greatest(i - off, 1) AS s FROM b JOIN st USING (gram)),
  q AS (SELECT p.rid, name, t.grams, list_distinct(list_transform(generate_series(s, least(s + n_words - 2, len(ws) - 1)), lambda j: ws[j] || ' ' || ws[j + 1])) AS mine FROM p JOIN t USING (k) JOIN whole USING (rid)),
  win AS (SELECT * FROM (SELECT rid, name, round(2.0 * len(list_intersect(mine, grams)) / (len(mine) + len(grams)), 6) AS dice FROM q) WHERE dice >= {threshold}),
  hits AS (SELECT rid, name, dice, 1 AS unit FROM best UNION ALL SELECT rid, name, dice, 0 FROM win),
  o AS (SELECT rid, sum(unit) AS n_units, count(*) - sum(unit) AS n_windows, max(dice) AS dice, array_to_string(list_sort(list_distinct(list(name))), ',') AS licences FROM hits GROUP BY rid),
  top AS (SELECT rid, name FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY dice DESC, name) AS r FROM hits) WHERE r = 1)
SELECT doc_id, top.name AS licence, coalesce(dice, 0.0) AS dice, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, CAST(coalesce(n_windows, 0) AS BIGINT) AS n_windows, coalesce(licences, '') AS licences
FROM d LEFT JOIN o USING (rid) LEFT JOIN top USING (rid)"""


def curriculum(share: float = 1.5, most: int = 2, schedules=mixing.SCHEDULES, seed: int = 11) -> str:
    """Sources in order of size by weight: those before some place are full, and the level that shares
    the rest among those from there on is the last one that fills none of them."""
    weights = [mixing.integrals(k)[-1] for k in schedules]

    def inverse(k: int) -> str:
        (_, a), (_, b) = schedules[k]
        y = f"(share * {weights[k]!r})"
        return f"least(2 * {y} / ({a!r} + sqrt(greatest({a * a!r} + {2 * (b - a)!r} * {y}, 0))), 1)"

    when = "CASE kind " + " ".join(f"WHEN {k} THEN {inverse(k)}" for k in range(len(schedules))) + " END"
    times = [f"CASE WHEN t{i} > 0 THEN round((SELECT {when} FROM (SELECT least((base + {i} * source_size) / greatest(target, 1), 1) AS share)), 9) END" for i in range(2)]
    taken = [f"greatest(least(base + {i} * source_size + size, floor(target)) - (base + {i} * source_size), 0)" for i in range(2)]
    return rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
  s AS (SELECT source, sum(size) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(schedules)} AS kind FROM d GROUP BY source),
  w AS (SELECT *, {weights!r}[kind + 1] AS weight, {float(most)!r} * source_size AS cap FROM s),
  o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, kind, source) AS k FROM w),
  l AS (SELECT *, ({share} * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
  g AS (SELECT source, source_size, kind, least(cap, weight * (SELECT first(level ORDER BY k) FROM l AS m WHERE m.cap > m.level * m.weight)) AS target FROM l),
  r AS (SELECT d.*, g.source_size, kind, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
  t AS (SELECT *, {taken[0]} AS t0, {taken[1]} AS t1 FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target, CAST(t0 + t1 AS BIGINT) AS taken, {times[0]} AS first_time, {times[1]} AS second_time FROM t"""


def spelling_variants(min_length: int = 7, min_count: int = 2, ratio: int = 10, spoil: int = 31) -> str:
    """CRC-32 by its table of 256, which is computed; near words by deleting each character in turn."""
    step = lambda c, b: f"xor({c} >> 8, t[(xor({c}, {b}) & 255) + 1])"
    bytes_of = "list_transform(range(strlen(k)), lambda i: CAST('0x' || substr(hex(k), 2 * i + 1, 2) AS BIGINT))"
    return rf"""
WITH RECURSIVE bits AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS c, 0 AS n FROM range(256)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
  tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8),
  tok AS (SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)),
  own AS (SELECT doc_id, w, count(*) AS n FROM tok GROUP BY ALL),
  crc AS (SELECT w, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_of}), lambda c, b: {step("c", "b")}), 4294967295) AS h
    FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS k FROM own), tab),
  said AS (SELECT CASE WHEN h % {spoil} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM crc),
  words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM said WHERE length(word) >= {min_length} GROUP BY word HAVING sum(n) >= {min_count}),
  cut AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
  half AS (SELECT DISTINCT a.word AS a, a.n AS na, b.word AS b, b.n AS nb FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION SELECT DISTINCT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.less = b.word),
  near AS (SELECT a, b, nb FROM half UNION SELECT b, a, na FROM half),
  best AS (SELECT a AS word, count(*) AS n_near, max(nb) AS most FROM near GROUP BY a),
  form AS (SELECT near.a AS word, min(b) AS form, any_value(most) AS form_n FROM near JOIN best ON near.a = best.word AND nb = most JOIN words ON words.word = near.a WHERE most >= {ratio} * n GROUP BY near.a),
  chain AS (SELECT word, word AS root, 0 AS k FROM words UNION ALL SELECT chain.word, form, k + 1 FROM chain JOIN form ON form.word = chain.root),
  last AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
SELECT words.word, form, root, n, coalesce(n_near, 0) AS n_near, form_n FROM words LEFT JOIN best USING (word) LEFT JOIN form USING (word) JOIN last USING (word)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_extendible_shards": shards(),
        "op3_exact_top_k": TOP_K,
        "op5_quality_rules": quality_rules(),
        "op7_chat_format": chat_format(),
        "op10_license_scan": license_scan(),
        "op11_curriculum_mix": curriculum(),
        "op13_spelling_variants": spelling_variants(),
    }
