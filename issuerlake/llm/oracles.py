"""DuckDB SQL of the queries that SQL can express.

Page texts, trained classifiers, token merges and matching with errors have no SQL form, and runs of words none
that ends in time on long texts; the tests compare those queries with a brute-force version, the public library or
labels held out.
"""

from issuerlake.llm import lines as _lines

ORACLES: dict[str, str] = {}

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WHITE = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

ORACLES["op2_minhash_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WHITE.format(_LOWER.format('text'))} AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM w),
nodes AS (SELECT min(doc_id) AS id, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT id, n, unnest(s) AS g FROM nodes),
rare AS (SELECT g, count(*) AS c FROM items GROUP BY g),
ranked AS (SELECT id, n, g, row_number() OVER (PARTITION BY id ORDER BY c, g) AS r FROM items JOIN rare USING (g)),
-- Of two similar sets one of the first n - ceil(0.8 n) + 1 shingles, rarest first, is common.
prefix AS (SELECT id, n, g FROM ranked WHERE r <= n - (80 * n + 99) // 100 + 1),
pairs AS (SELECT DISTINCT a.id AS u, b.id AS v FROM prefix a JOIN prefix b ON a.g = b.g AND a.id < b.id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
common AS (SELECT u, v, len(list_intersect(x.s, y.s)) AS c, x.n + y.n AS n
  FROM pairs JOIN nodes x ON x.id = u JOIN nodes y ON y.id = v),
links AS (SELECT u, v FROM common WHERE 100 * c >= 80 * (n - c)),
edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT id AS x, id AS y FROM nodes UNION SELECT reach.x, edges.v FROM reach JOIN edges ON edges.u = reach.y),
comp AS (SELECT x, min(y) AS component FROM reach GROUP BY x)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id,
  doc_id = coalesce(component, doc_id) AS kept
FROM sets LEFT JOIN nodes ON sets.s = nodes.s AND len(sets.s) > 0 LEFT JOIN comp ON comp.x = nodes.id
"""

_GIVEN = r"""["'']?\x20*[:=]\x20*["'']?"""
_ASSIGN = rf"(?i:password|passwd|secret|token|api_?key){_GIVEN}"
_KINDS = [
    ("assign", "secret", rf"{_ASSIGN}[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(m, '^{_ASSIGN}', '')) >= 8"),
    ("access", "name", "AKIA[A-Z0-9]+", "length(m) >= 16"),
    ("hex", "secret", "[0-9a-f]+", "length(m) >= 32"),
    ("name", "name", rf"\b(?i:access_?key_?id|client_?id|account_?id|user_?name|user_?id|login|user){_GIVEN}[A-Za-z0-9._@-]+", "true"),
    ("weak", "secret", rf"\b(?i:pwd|passphrase|pass|credentials?|auth_?key|private_?key){_GIVEN}[A-Za-z0-9+/_.=-]+", "true"),
    ("address", "address", r"\b[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%:@/?&=+-]+", "true"),
]
# Only runs of 32 and more split the text for hex, as shorter ones would be every other letter.
_SPLIT = {"hex": "[0-9a-f]{32,}"}


def _found(n: int, kind: str, role: str, pattern: str, good: str) -> str:
    pattern = _SPLIT.get(kind, pattern)
    return f"""SELECT doc_id, {n} AS rank, '{kind}' AS kind, '{role}' AS role, s AS start, s + length(m) AS "end" FROM (
  SELECT doc_id, m, list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT doc_id, g, h, unnest(h) AS m, unnest(range(1, len(h) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}') AS h FROM documents))) WHERE {good}"""


_JOINED = """string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank, "end")"""
ORACLES["op3_secret_scan"] = f"""
WITH parts AS ({" UNION ALL ".join(_found(n, *k) for n, k in enumerate(_KINDS))}),
spans AS (
  SELECT * FROM parts WHERE rank < 3
  UNION ALL SELECT * FROM parts l WHERE rank >= 3 AND EXISTS (
    SELECT 1 FROM parts r WHERE r.doc_id = l.doc_id AND r.start <= l."end" + 200 AND r."end" >= l.start - 200
    AND (l.role = 'secret') <> (r.role = 'secret'))),
base AS (SELECT doc_id, {_JOINED} AS t, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS b,
  count(*) FILTER (rank = 2) AS c FROM spans WHERE rank < 3 GROUP BY doc_id),
everything AS (SELECT doc_id, {_JOINED} AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(t, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN base USING (doc_id) LEFT JOIN everything USING (doc_id)
"""

ORACLES["op8_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES["op9_decontamination"] = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_PLAIN.format(_LOWER.format('text'))} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_PLAIN.format(_LOWER.format('text'))} AS w FROM documents),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))),
found AS (SELECT doc_id, item, i, p.n FROM places p JOIN windows USING (g, n)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_MENU = ", ".join(f"'{w}'" for w in _lines.MENU)
_REPEATS = "len(list_filter(range(1, n), lambda i: w[i] = w[i + 1]))"
ORACLES["op11_quality_rules"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_WHITE.format("coalesce(text, '')")} AS w FROM documents),
cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
known AS (SELECT doc_id, line, {_LOWER.format('line')} AS lower, {_WHITE.format(_LOWER.format('line'))} AS w, len(w) AS n
  FROM cut WHERE len({_WHITE.format('line')}) > 0),
judged AS (SELECT doc_id, line, n, CASE
  WHEN NOT regexp_matches(lower, '{_lines.SENTENCE.replace("'", "''")}') THEN 0
  WHEN len(regexp_extract_all(lower, '{_lines.ODD}')) >= 2 AND 2 * len(regexp_extract_all(lower, '{_lines.ODD}')) >= n THEN 0
  WHEN len(regexp_extract_all(lower, '{_lines.SEPARATOR}')) >= 2 AND 4 * len(regexp_extract_all(lower, '{_lines.SEPARATOR}')) >= n THEN 1
  WHEN n <= 8 AND len(list_filter(w, lambda x: rtrim(x, '.!?') NOT IN ({_MENU}))) = 0 THEN 1
  WHEN n <= 20 AND regexp_matches(lower, '{"|".join(_lines.PHRASES)}') THEN 2
  WHEN {_REPEATS} >= 3 AND 2 * {_REPEATS} >= n THEN 2 END AS rule FROM known),
per_line AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, coalesce(sum(n) FILTER (rule = 0), 0)::BIGINT AS a,
  coalesce(sum(n) FILTER (rule = 1), 0)::BIGINT AS b, coalesce(sum(n) FILTER (rule = 2), 0)::BIGINT AS c FROM judged GROUP BY doc_id),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)),
twice AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM windows JOIN twice USING (doc_id, g)) GROUP BY doc_id),
counted AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
  coalesce(r.n, 0) AS n_repeat_words, coalesce(a, 0) AS lost_punctuation, coalesce(b, 0) AS lost_navigation, coalesce(c, 0) AS lost_boilerplate
  FROM docs LEFT JOIN per_line USING (doc_id) LEFT JOIN repeated r USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * (lost_punctuation + lost_navigation + lost_boilerplate) <= n_words AS kept
FROM counted
"""

ORACLES["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
  list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
