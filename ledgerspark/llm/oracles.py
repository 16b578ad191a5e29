"""The queries that SQL can express, as DuckDB runs them on the same tables."""

from __future__ import annotations

import string

#: Words, and A-Z in lower case alone.
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP1 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT doc_id, b, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, a, md5(b[a + 1 : a + 200]) AS k FROM n, range(n - 199) AS r(a) WHERE n >= 200),
again AS (SELECT doc_id, a FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT doc_id, a, coalesce(a > lag(a) OVER (PARTITION BY doc_id ORDER BY a) + 200, true) AS new FROM again),
numbered AS (SELECT doc_id, a, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM marked),
spans AS (SELECT doc_id, min(a) AS x, max(a) + 200 AS y FROM numbered GROUP BY doc_id, span),
rests AS (
  SELECT doc_id, coalesce(lag(y) OVER (PARTITION BY doc_id ORDER BY x), 0) AS x, x AS y FROM spans
  UNION ALL SELECT n.doc_id, coalesce(max(s.y), 0), any_value(n.n) FROM n LEFT JOIN spans s ON s.doc_id = n.doc_id GROUP BY n.doc_id),
kept AS (SELECT r.doc_id, string_agg(CASE WHEN r.y > r.x THEN hex(n.b[r.x + 1 : r.y]) ELSE '' END, '' ORDER BY r.x) AS h FROM rests r JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id),
gone AS (SELECT doc_id, sum(y - x) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT n.doc_id, n.n::BIGINT AS n_bytes, coalesce(g.n_removed, 0)::BIGINT AS n_removed, coalesce(g.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM n JOIN kept k ON k.doc_id = n.doc_id LEFT JOIN gone g ON g.doc_id = n.doc_id
"""

OP2 = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS k FROM d, range(1, len(w) - 48) AS r(i) WHERE len(w) >= 50),
least AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
again AS (SELECT doc_id, i FROM windows JOIN least USING (k) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM again, range(50) AS r(j)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS x FROM d, range(1, len(w) - 3) AS r(i) WHERE len(w) >= 5
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT o.a, o.b FROM shared o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * o.c >= 75 * (x.n + y.n - o.c)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least.component_id FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_ESCAPED = r"replace(replace({}, '\', '\\'), '<|', '<\|')"

#: budget 512, at most 2 turns of history with 128 tokens
OP6 = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, x.turn, x.role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) x(turn, role)),
sized AS (SELECT *, ceil(octet_length(encode(text)) / 4)::BIGINT + 4 AS size, row_number() OVER o AS place FROM rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
long AS (
  SELECT *, 12 + length(replace({_ESCAPED.format("role")}, chr(10), '<\\n')) + 1 + length({_ESCAPED.format("text")}) + 11 AS chars,
    first_value(CASE WHEN role = 'system' AND size <= 256 THEN size ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY place) AS fixed FROM sized),
half AS (SELECT *, (512 - fixed - 128) // 2 AS half FROM long),
sums AS (
  SELECT *, sum(size) OVER o AS upto, sum(CASE WHEN size > half THEN 0 ELSE size END) OVER o AS small, sum((size > half)::INT) OVER o AS larges
  FROM half WINDOW o AS (PARTITION BY conv_id ORDER BY place)),
marked AS (SELECT *, CASE WHEN small = 0 THEN 0 ELSE (small - 1) // half END AS stretch FROM sums),
opened AS (
  SELECT *, coalesce(lag(stretch) OVER o <> stretch OR lag(larges) OVER o <> larges OR lag(size > half) OVER o <> (size > half), true) AS new
  FROM marked WINDOW o AS (PARTITION BY conv_id ORDER BY place)),
spans AS (SELECT *, sum(new::INT) OVER (PARTITION BY conv_id ORDER BY place) AS span FROM opened),
windows AS (
  SELECT conv_id, span, min(place) AS first, arg_min(upto - size, place) AS before, sum(size) AS size, sum(chars) AS chars, CASE WHEN min(place) > 1 THEN any_value(fixed) ELSE 0 END AS fixed
  FROM spans GROUP BY conv_id, span),
context AS (
  SELECT w.conv_id, sum(s.chars) AS chars FROM windows w JOIN spans s ON s.conv_id = w.conv_id
  WHERE (w.fixed > 0 AND s.place = 1)
    OR (s.place BETWEEN w.first - 2 AND w.first - 1 AND w.before - (s.upto - s.size) <= least(128, 512 - w.fixed - w.size) AND NOT (w.fixed > 0 AND s.place = 1))
  GROUP BY w.conv_id),
said AS (
  SELECT conv_id, count(*) AS n, sum(chars) AS chars, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS learnt
  FROM spans GROUP BY conv_id)
SELECT said.conv_id::BIGINT AS conv_id, n::BIGINT AS n_turns, turns_sha256, length(learnt)::BIGINT AS loss_chars, sha256(learnt) AS loss_sha256, (said.chars + coalesce(context.chars, 0))::BIGINT AS formatted_chars
FROM said LEFT JOIN context USING (conv_id)
"""

ORACLE_SQL: dict[str, str] = {"op1_suffix_array_dedup": OP1, "op2_substring_dedup": OP2, "op5_ngram_jaccard_join": OP5, "op6_chat_formatting": OP6}
