"""DuckDB SQL for the operators that SQL can express, over the given tables."""

from __future__ import annotations

from regfuse.llm import licenses, line_dedup

SPACE = r"[\x20\x09-\x0D]+"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS h FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS kept
FROM sets s LEFT JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.s
"""

LINES = rf"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM documents),
masked AS (
  SELECT doc_id, line, raw,
    regexp_replace(trim(regexp_replace(raw, '{SPACE}', ' ', 'g'), ' '), '[^\x20]*({line_dedup.VARIABLE})[^\x20]*', '{line_dedup.FIELD}', 'g') AS m
  FROM raw),
lines AS (
  SELECT *, string_split(m, ' ') AS tok,
    len(string_split(m, ' '))::VARCHAR || ' ' || array_to_string(string_split(m, ' ')[1:{line_dedup.DEPTH}], ' ') AS leaf
  FROM masked WHERE m <> ''),
own AS (SELECT m FROM lines GROUP BY m HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
open AS (SELECT leaf FROM lines GROUP BY leaf HAVING count(DISTINCT doc_id) > 1 AND count(DISTINCT m) > 1),
forms AS (SELECT DISTINCT leaf, m, tok FROM lines WHERE leaf IN (SELECT leaf FROM open)),
places AS (SELECT * FROM (SELECT leaf, unnest(tok) AS token, generate_subscripts(tok, 1) AS place FROM forms) WHERE place > {line_dedup.DEPTH}),
counts AS (SELECT leaf, place, token, count(*) AS n, sum(count(*)) OVER (PARTITION BY leaf, place) AS all_n FROM places GROUP BY leaf, place, token),
fixed AS (SELECT leaf, place, token FROM counts WHERE 2 * n > all_n),
rest AS (
  SELECT doc_id, line, leaf, len(tok) AS size, unnest(tok) AS token, generate_subscripts(tok, 1) AS place
  FROM lines WHERE leaf IN (SELECT leaf FROM open) AND m NOT IN (SELECT m FROM own)),
alike AS (
  SELECT r.doc_id, r.line, r.leaf FROM rest r JOIN fixed f ON r.leaf = f.leaf AND r.place = f.place AND r.token = f.token
  GROUP BY r.doc_id, r.line, r.leaf, r.size
  HAVING count(*) FILTER (r.token <> '{line_dedup.FIELD}') >= greatest(1,
    {line_dedup.SIMILARITY} * (r.size - {line_dedup.DEPTH} - count(*) FILTER (r.token = '{line_dedup.FIELD}')))),
general AS (SELECT * FROM alike WHERE leaf IN (SELECT leaf FROM alike GROUP BY leaf HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS})),
found AS (
  SELECT doc_id, line, 'own ' || m AS template FROM lines WHERE m IN (SELECT m FROM own)
  UNION ALL SELECT doc_id, line, 'leaf ' || leaf FROM general),
ranked AS (SELECT doc_id, line, row_number() OVER (PARTITION BY template ORDER BY doc_id, line) AS nth FROM found),
dropped AS (SELECT doc_id, line FROM ranked WHERE nth > 1),
per_doc AS (
  SELECT m.doc_id, count(*) FILTER (m.m <> '') AS n_lines, count(d.line) AS n_dropped,
    coalesce(string_agg(m.raw, chr(10) ORDER BY m.line) FILTER (d.line IS NULL), '') AS text
  FROM masked m LEFT JOIN dropped d ON m.doc_id = d.doc_id AND m.line = d.line GROUP BY m.doc_id)
SELECT doc_id, n_lines, n_dropped, length(text) AS n_chars, md5(text) AS text_md5 FROM per_doc
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(line: str) -> str:
    kept = f"CASE WHEN regexp_matches(lower({line}), {_quoted(licenses.COPYRIGHT_LINE)}) THEN '' ELSE lower({line}) END"
    for old, new in licenses.SPELLINGS:
        kept = f"replace({kept}, {_quoted(old)}, {_quoted(new)})"
    return f"trim(regexp_replace({kept}, {_quoted(licenses.OTHER)}, ' ', 'g'), ' ')"


_JOINED = "array_to_string(list_filter(lines, lambda x: x <> ''), ' ')"
LICENSES = f"""
WITH known_texts(license_id, text) AS (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licenses.KNOWN)}),
known_lines AS (SELECT license_id, list_transform(string_split(text, chr(10)), lambda l: {_canonical("l")}) AS lines FROM known_texts),
known AS (SELECT DISTINCT license_id, {_JOINED} AS unit FROM known_lines),
docs AS (SELECT doc_id, list_transform(string_split_regex(text, '\\r\\n|\\n|\\r'), lambda l: {_canonical("l")}) AS lines FROM documents),
cut AS (
  SELECT doc_id, lines, list_filter(string_split_regex(
    array_to_string(list_transform(lines, lambda x: CASE WHEN x = '' THEN chr(10) ELSE x END), ' '), ' ?\\n[\\n ]*'), lambda p: p <> '') AS paragraphs
  FROM docs),
units AS (
  SELECT doc_id, 'whole' AS kind, {_JOINED} AS unit FROM cut
  UNION ALL SELECT DISTINCT doc_id, 'part', unnest(CASE WHEN len(lines) > 1
    THEN list_concat(CASE WHEN len(paragraphs) > 1 THEN paragraphs ELSE [] END, lines) ELSE [] END) FROM cut),
hits AS (
  SELECT u.doc_id, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS licenses,
    count(*) FILTER (u.kind = 'part') AS n_notices, bool_or(u.kind = 'whole') AS whole_text
  FROM units u JOIN known k ON u.unit = k.unit WHERE u.unit <> '' GROUP BY u.doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_notices, 0) AS n_notices, coalesce(whole_text, false) AS whole_text
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN hits h ON d.doc_id = h.doc_id
"""

NEAREST = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_dot_product(a.e, v.e)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id AND len(a.e) = len(v.e)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
found AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""

WEB_ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, (5 * i) // 4 + 1, 2))::INT >> (3 - (5 * i) % 4)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
docs AS (SELECT doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs)
       WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
parts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS part
          FROM tf JOIN df USING (term), total),
scored AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM wanted JOIN parts USING (term) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE = {
    "op1_minhash_near_dedup": NEAR_DUPLICATES,
    "op2_line_dedup": LINES,
    "op3_license_scan": LICENSES,
    "op5_nearest_neighbours": NEAREST,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_web_archives": WEB_ARCHIVES,
    "op13_lexical_search": LEXICAL_SEARCH,
}
