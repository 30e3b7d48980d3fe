"""Independent SQL (DuckDB) for the corpus queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM bw WHERE len(w) > 0)),
found AS (
  SELECT d.doc_id, d.i, d.n, b.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
        FROM (SELECT dw.*, s.n, unnest(range(1, len(w) - s.n + 2)) AS i
              FROM dw, (SELECT DISTINCT n FROM windows) s WHERE len(w) >= s.n)) d
  JOIN windows b ON b.n = d.n AND b.win = d.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_EXACT = f"""
WITH t AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


_JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
linked AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * common >= 75 * (na.n + nb.n - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN linked l ON l.a = r.other)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
o AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS earlier,
         length(replace(replace(replace(text, '\', '##'), '<', '##'), '>', '##')) AS text_chars,
         length(replace(replace(replace(role, '\', '##'), '<', '##'), '>', '##')) AS role_chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN earlier IS NOT DISTINCT FROM role THEN 3 ELSE 14 + role_chars END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""


_RANKED = f"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
size AS (SELECT r, any_value(doc_id) AS doc_id, any_value(len(w)) AS n FROM dw WHERE len(w) > 0 GROUP BY r),
total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
asked AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM dw) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, total GROUP BY term),
scored AS (
  SELECT item_id, size.r, any_value(doc_id) AS doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (r), total GROUP BY item_id, size.r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_formatting": _CHAT,
        "op6_benchmark_decontamination": _DECONTAMINATION,
        "op9_exact_dedup": _EXACT,
        "op10_ngram_jaccard_join": _JACCARD,
        "op11_ranked_search": _RANKED,
    }
