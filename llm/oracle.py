"""SQL counterparts of the queries for DuckDB, where SQL can express them."""

from __future__ import annotations

from llm import licenses

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _crc32(text: str) -> str:
    """crc32 of ASCII text, bit by bit."""
    octets = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    step = "list_reduce(list_concat([xor(acc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda acc, b: {step}), 4294967295)"


# Words q apart that are equal, in stretches; a stretch of the smallest period has the same ends as those of its multiples.
RUNS = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own,
        {_crc32("doc_id::VARCHAR")} AS h
    FROM documents
), places AS (
    SELECT *, len(own) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(own) > 0 THEN (h // 10) % len(own) END AS a FROM docs
), made AS (
    SELECT r, doc_id, n, CASE WHEN a IS NULL THEN own ELSE list_transform(range(n), lambda i: CASE
        WHEN i < a THEN own[i + 1] ELSE own[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) END AS words
    FROM places
), words AS (
    SELECT r, n, unnest(words) AS word, unnest(range(n)) AS i FROM made
), equal AS (
    SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i
    WHERE 3 * (y.i - x.i) <= x.n
), marked AS (
    SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal
), stretches AS (
    SELECT r, q, min(i) AS start, count(*) + q AS length FROM marked GROUP BY r, q, island
    HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
    SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length
), gone AS (
    SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS text FROM words w LEFT JOIN gone g ON w.r = g.r AND w.i = g.i
    WHERE g.r IS NULL GROUP BY w.r
), listed AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing
    FROM runs GROUP BY r
), best AS (
    SELECT a.* FROM runs a WHERE NOT EXISTS (
        SELECT 1 FROM runs b WHERE b.r = a.r AND (b.length * a.period > a.length * b.period
            OR b.length * a.period = a.length * b.period AND (b.start, b.period) < (a.start, a.period)))
)
SELECT m.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length::BIGINT AS length, b.period::BIGINT AS period,
    (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(l.listing, '')) AS runs_sha256,
    sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM made m LEFT JOIN listed l ON m.r = l.r LEFT JOIN best b ON m.r = b.r LEFT JOIN kept k ON m.r = k.r
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licenses() -> str:
    known = licenses.Templates(licenses.TEMPLATES, licenses.PERCENT)
    texts = {i: w.decode() for w, i in known.numbers.items()}
    words = ", ".join(f"({t}, {_quoted(texts[w])})" for t, ws in enumerate(known.sets) for w in ws)
    asked = ", ".join(
        f"({t}, {_quoted(label)}, {len(ws)}, {need})" for t, (label, ws, need) in enumerate(zip(known.labels, known.sets, known.needs))
    )
    wider = ", ".join(f"({t}, {o})" for t, others in enumerate(known.wider) for o in others)
    phrases = ", ".join(f"({_quoted(p)}, {_quoted(label)}, {len(p.split())})" for p, label in licenses.PHRASES.items())
    longest = max(len(p.split()) for p in licenses.PHRASES)
    ahead = " || ' ' || ".join(f"coalesce(lead(word, {k}) OVER w, '')" for k in range(1, longest))
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS text FROM documents
), template(t, label, size, need) AS (VALUES {asked}), template_word(t, word) AS (VALUES {words}),
wider(t, o) AS (VALUES {wider}), phrase(phrase, label, size) AS (VALUES {phrases}),
words AS (
    SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM (SELECT r, regexp_extract_all(text, '{_WORD}') AS ws FROM docs)
), ahead AS (
    SELECT r, i, word || ' ' || {ahead} || ' ' AS seen FROM words WINDOW w AS (PARTITION BY r ORDER BY i)
), places AS (
    SELECT r, i, label FROM ahead JOIN phrase ON starts_with(seen, phrase || ' ')
), base AS (
    SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY r
), lines AS (
    SELECT r, line, regexp_extract_all(text, '{_WORD}') AS ws FROM (
        SELECT r, unnest(ls) AS text, unnest(range(len(ls))) AS line FROM (SELECT r, string_split(text, chr(10)) AS ls FROM docs))
), filled AS (
    SELECT *, line - row_number() OVER (PARTITION BY r ORDER BY line) AS island FROM lines WHERE len(ws) > 0
), blocks AS (
    SELECT r, line, 1 AS lines, list_distinct(ws) AS ws FROM filled
    UNION ALL
    SELECT r, min(line), count(*), list_distinct(flatten(list(ws))) FROM filled GROUP BY r, island HAVING count(*) > 1
), overlap AS (
    SELECT r, line, lines, t, count(*) AS common
    FROM (SELECT r, line, lines, unnest(ws) AS word FROM blocks) JOIN template_word USING (word) GROUP BY ALL
), held AS (
    SELECT r, line, lines, t, label, common::DOUBLE / size AS share FROM overlap JOIN template USING (t) WHERE common >= need
), notices AS (
    SELECT * FROM held h WHERE NOT EXISTS (
        SELECT 1 FROM wider JOIN held o ON o.t = wider.o WHERE wider.t = h.t AND (o.r, o.line, o.lines) = (h.r, h.line, h.lines))
), labelled AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT r, label FROM places UNION SELECT r, label FROM notices) GROUP BY r
), based AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r
), shares AS (
    SELECT r, max(share) AS share FROM notices GROUP BY r
), counts AS (
    SELECT r, count(*) AS n_words FROM words GROUP BY r
)
SELECT d.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
    coalesce(x.base_labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
    CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(s.share, 0.0::DOUBLE) END AS score
FROM docs d LEFT JOIN counts c ON d.r = c.r LEFT JOIN base b ON d.r = b.r LEFT JOIN based x ON d.r = x.r
LEFT JOIN labelled l ON d.r = l.r LEFT JOIN shares s ON d.r = s.r
"""


NEGATIVES = """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0
), good AS (
    SELECT * FROM scores WHERE same AND vec_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
), bad AS (
    SELECT g.anchor_id, g.vec_id AS positive_id, s.vec_id AS negative_id, g.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY g.r, g.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM good g JOIN scores s ON g.r = s.r AND NOT s.same AND 50 * g.score <= 100 * s.score AND 100 * s.score <= 95 * g.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM bad WHERE rank <= 3
"""


NEAR_VECTORS = """
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
    SELECT * FROM rows
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
        AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.r AS a, b.r AS b, b.vec_id FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT r AS a, r AS b FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
    SELECT reach.a, min(rows.vec_id) AS component_id FROM reach JOIN rows ON reach.b = rows.r GROUP BY reach.a
), counts AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM rows JOIN components ON rows.r = components.a LEFT JOIN counts ON rows.r = counts.a
"""


LEAKS = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents
), items AS (
    SELECT DISTINCT item_id::VARCHAR AS item, ws FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM benchmark)
    WHERE len(ws) > 0
), windows AS (
    SELECT DISTINCT item, size, array_to_string(ws[i + 1 : i + size], ' ') AS win
    FROM (SELECT item, ws, least(10, len(ws)) AS size, unnest(range(greatest(1, len(ws) - 9))) AS i FROM items)
), sizes AS (
    SELECT DISTINCT size FROM windows
), grams AS (
    SELECT r, i, size, array_to_string(ws[i + 1 : i + size], ' ') AS win
    FROM (SELECT r, ws, size, unnest(range(len(ws) - size + 1)) AS i FROM docs JOIN sizes ON len(ws) >= size)
), hits AS (
    SELECT r, i, g.size, item FROM grams g JOIN windows w ON g.size = w.size AND g.win = w.win
), hit_words AS (
    SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS i FROM hits) GROUP BY r
), hit_items AS (
    SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listing FROM hits GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listing, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


# Bytes as two hexadecimal digits each, since SQL counts characters.
REPEATS = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h FROM documents
), pieces AS (
    SELECT r, doc_id, base, substr(h, 2 * base + 1, 1198) AS h FROM (
        SELECT *, unnest(range(0, length(h) // 2 - 99, 500)) AS base FROM docs WHERE length(h) >= 200)
), starts AS (
    SELECT r, doc_id, base + j AS i, md5_number(substr(h, 2 * j + 1, 200)) AS s, doc_id::HUGEINT * 4294967296 + base + j AS place FROM (
        SELECT *, unnest(range(least(500, length(h) // 2 - 99))) AS j FROM pieces)
), firsts AS (
    SELECT s, min(place) AS earliest FROM starts GROUP BY s HAVING count(*) > 1
), covered AS (
    SELECT DISTINCT r, unnest(range(i, i + 100)) AS i FROM starts JOIN firsts USING (s) WHERE place > earliest
), runs AS (
    SELECT r, count(*) AS n, min(i) AS a, max(i) AS b
    FROM (SELECT r, i, i - row_number() OVER (PARTITION BY r ORDER BY i) AS island FROM covered) GROUP BY r, island
), removed AS (
    SELECT r, sum(n)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY r
), kept AS (
    SELECT r, string_agg(piece, '' ORDER BY a) AS h FROM (
        SELECT d.r, b.a, substr(d.h, 2 * b.b + 3, 2 * (coalesce(lead(b.a) OVER (PARTITION BY d.r ORDER BY b.a), length(d.h) // 2) - b.b - 1)) AS piece
        FROM docs d JOIN (SELECT r, a, b FROM runs UNION ALL SELECT r, -1, -1 FROM removed) b ON d.r = b.r) GROUP BY r
)
SELECT doc_id, (length(docs.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept.h, docs.h))) AS kept_sha256
FROM docs LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""


ORACLES: dict[str, str] = {
    "op5_pivots": NEAR_VECTORS,
    "op6_decontaminate": LEAKS,
    "op7_suffix": REPEATS,
    "op11_runs": RUNS,
    "op12_licenses": _licenses(),
    "op13_negatives": NEGATIVES,
}
