"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

from orderloom.llm.licences import LEAST, TEMPLATES

_SPACE = "'[\\x20\\x09-\\x0D]'"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _lower(column: str) -> str:
    return _LOWER.format(column)


LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, position, line,
         {_lower("regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '')")} AS line_key
  FROM (
    SELECT doc_id, unnest(split) AS line, generate_subscripts(split, 1) AS position
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents)
  )
),
owners AS (SELECT line_key, min(doc_id) AS owner FROM lines WHERE length(line_key) >= 10 GROUP BY line_key),
marked AS (
  SELECT l.doc_id, l.position, l.line, coalesce(o.owner <> l.doc_id, false) AS dropped
  FROM lines l LEFT JOIN owners o ON o.line_key = l.line_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SUBSTRING_DEDUP = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS s FROM words WHERE len(w) >= 35),
windows AS (
  SELECT s.doc_id, s.s, md5(array_to_string(list_slice(w.w, s.s, s.s + 34), ' ')) AS key
  FROM starts s JOIN words w USING (doc_id)
),
repeated AS (SELECT key FROM windows GROUP BY key HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS position FROM windows JOIN repeated USING (key)
),
positions AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS position FROM words),
kept AS (
  SELECT p.doc_id, count(c.position) AS n_removed,
         string_agg(p.word, ' ' ORDER BY p.position) FILTER (WHERE c.position IS NULL) AS kept
  FROM positions p LEFT JOIN covered c ON c.doc_id = p.doc_id AND c.position = p.position
  GROUP BY p.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

DECONTAMINATION = f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         list_slice(w, s, s + least(len(w), 13) - 1) AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
doc_words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
spots AS (
  SELECT doc_id, w, z.n, unnest(range(1, len(w) - z.n + 2)) AS s FROM doc_words, sizes z WHERE len(w) >= z.n
),
hits AS (
  SELECT d.doc_id, d.s, d.n, x.item_id
  FROM spots d JOIN windows x ON x.n = d.n AND x.words = list_slice(d.w, d.s, d.s + d.n - 1)
),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, s, s + 2), ' ')) AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS s FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM words
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id,
       r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

_TEMPLATE_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in sorted(TEMPLATES.items()))


def _bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


LICENCES = f"""
WITH templates AS (
  SELECT licence, {_bigrams("w")} AS b
  FROM (SELECT licence, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM (VALUES {_TEMPLATE_ROWS}) v(licence, t))
),
units AS (
  SELECT doc_id, 0 AS unit, coalesce(text, '') AS part FROM documents
  UNION ALL
  SELECT doc_id, unnest(range(1, len(lines) + 1)), unnest(lines)
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE contains(text, chr(10)))
),
cut AS (
  SELECT doc_id, unit, {_bigrams("w")} AS b
  FROM (SELECT doc_id, unit, regexp_extract_all({_lower("part")}, '[a-z0-9]+') AS w FROM units)
),
scored AS (
  SELECT doc_id, unit, licence, 2.0::DOUBLE * len(list_intersect(c.b, t.b)) / (len(c.b) + len(t.b)) AS dice
  FROM cut c JOIN templates t ON len(c.b) BETWEEN 1 AND 5 * len(t.b)
),
matches AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, licence) AS place
  FROM scored WHERE dice >= {LEAST}::DOUBLE
),
best AS (
  SELECT doc_id, unit, licence, dice, count(*) OVER (PARTITION BY doc_id) AS n_matched,
         row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, unit) AS place
  FROM matches WHERE place = 1
)
SELECT d.doc_id, coalesce(b.n_matched, 0) AS n_matched, b.licence, b.dice, CAST(b.unit AS INTEGER) AS unit
FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.place = 1
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
grams AS (
  SELECT lang, k, unnest([array_to_string(words[i : i + k - 1], ' ') FOR i IN range(1, len(words) - k + 2)]) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(words) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k > 1 AND f >= 30),
inner_phrases AS (
  SELECT lang, a, array_to_string(words[i : i + size - 1], ' ') AS phrase
  FROM candidates, (VALUES (2), (3)) AS sizes(size), (VALUES (1), (2), (3)) AS places(i)
  WHERE size < k AND i + size - 1 <= k),
around AS (SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN around o USING (lang, phrase)
  WHERE o.most IS NULL OR 100 * o.most::HUGEINT < 80 * c.a::HUGEINT),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, (2000000 * c.a::HUGEINT // (l.f::HUGEINT + r.f::HUGEINT))::BIGINT AS score
  FROM kept c, (VALUES (1), (2), (3)) AS cuts(cut)
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1 : cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[cut + 1 : ], ' ')
  WHERE cut < c.k),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
