"""DuckDB SQL of the corpus queries that SQL can state."""

from __future__ import annotations

#: op6: turns in order; a copy of each conversation with the next one's last answer; conversations of one opening; their turns.
OP6 = """WITH own AS (
  SELECT conv_id, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS position
  FROM conversations WHERE conv_id IS NOT NULL),
answers AS (
  SELECT conv_id, position AS place, text AS answer FROM own WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY position DESC) = 1),
next_answers AS (
  SELECT conv_id, place, CASE WHEN row_number() OVER (ORDER BY conv_id DESC) = 1 THEN first_value(answer) OVER (ORDER BY conv_id)
    ELSE lead(answer) OVER (ORDER BY conv_id) END AS answer
  FROM answers),
turns AS (
  SELECT 'original' AS version, conv_id, position, role, text FROM own
  UNION ALL
  SELECT 'copy', conv_id, position, role, CASE WHEN position = place THEN answer ELSE text END
  FROM own JOIN next_answers USING (conv_id)),
shown AS (
  SELECT version, conv_id, position, role, text, rendered, length(rendered) AS n_chars, CAST(coalesce(sum(length(rendered)) OVER (
    PARTITION BY version, conv_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM (SELECT *, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS rendered FROM turns)),
openings AS (
  SELECT conv_id, role, text, worth FROM own
  JOIN (SELECT conv_id, coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS worth FROM own GROUP BY conv_id) USING (conv_id)
  WHERE position = 0),
pairs AS (
  SELECT 'opening' AS kind, conv_id AS pair_id, 'original' AS version,
    first_value(conv_id) OVER (PARTITION BY role, text ORDER BY worth DESC, CAST(conv_id AS VARCHAR)) AS chosen
  FROM openings QUALIFY conv_id <> chosen
  UNION ALL
  SELECT 'swapped', conv_id, 'copy', conv_id FROM next_answers),
agreed AS (
  SELECT kind, pair_id, any_value(p.version) AS version, any_value(p.chosen) AS chosen, coalesce(min(c.position) FILTER (
    WHERE c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text), count(*)) AS common
  FROM pairs AS p
  JOIN turns AS c ON c.version = 'original' AND c.conv_id = p.chosen
  JOIN turns AS r ON r.version = p.version AND r.conv_id = p.pair_id AND r.position = c.position
  GROUP BY kind, pair_id),
sides AS (
  SELECT kind, pair_id, common, 'chosen' AS side, s.* FROM agreed AS a JOIN shown AS s ON s.version = 'original' AND s.conv_id = a.chosen
  UNION ALL
  SELECT kind, pair_id, common, 'rejected', s.* FROM agreed AS a JOIN shown AS s
    ON s.version = a.version AND s.conv_id = a.pair_id AND s.position >= a.common)
SELECT kind, pair_id, conv_id, CASE WHEN position < common THEN 'prompt' ELSE side END AS part, position, role, start, n_chars,
  coalesce(position >= common AND role = 'assistant', false) AS learned, sha256(rendered) AS rendered_sha256
FROM sides"""

#: op7: equal sets are one class; classes that may be linked share one of their rarest shingles (as many of them as a linked set
#: can lack, and one more); links are checked on whole sets and followed to their ends.
OP7 = r"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words),
classes AS (SELECT min(doc_id) AS class, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
members AS (SELECT class, n, unnest(s) AS shingle FROM classes),
rare AS (
  SELECT class, n, shingle, row_number() OVER (PARTITION BY class ORDER BY often, shingle) AS place
  FROM members JOIN (SELECT shingle, count(*) AS often FROM members GROUP BY shingle) USING (shingle)),
heads AS (SELECT class, shingle FROM rare WHERE place <= n - (85 * n + 99) // 100 + 1),
candidates AS (SELECT DISTINCT a.class AS x, b.class AS y FROM heads AS a JOIN heads AS b USING (shingle) WHERE a.class < b.class),
shared AS (
  SELECT x, y, p.n + q.n AS both_sizes, len(list_intersect(p.s, q.s)) AS common
  FROM candidates JOIN classes AS p ON p.class = x JOIN classes AS q ON q.class = y),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 85 * (both_sizes - common)),
edges AS (SELECT x AS u, y AS v FROM links UNION ALL SELECT y, x FROM links),
reached(class, other) AS (
  SELECT class, class FROM classes UNION SELECT r.class, e.v FROM reached AS r JOIN edges AS e ON e.u = r.other),
components AS (SELECT class, min(other) AS component FROM reached GROUP BY class)
SELECT doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
  coalesce(component, doc_id) = doc_id AS kept
FROM sets AS d LEFT JOIN classes AS c ON c.s = d.s LEFT JOIN components USING (class)"""
