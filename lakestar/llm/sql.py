"""DuckDB SQL for the queries of conversation repair and the filter interaction audit."""

FILTER_AUDIT = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
split AS (
  SELECT t.*, f.first_id, list_filter(regexp_split_to_array(t.text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM texts t JOIN firsts f ON t.text = f.text),
told AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failed AS (
  SELECT s.part, coalesce(l.good, 0) AS good, coalesce(l.bad, 0) AS bad,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(s.text, '[^A-Z]', '', 'g')) > 3 * length(s.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(s.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN s.doc_id > s.first_id THEN 'E' ELSE '' END AS fails
  FROM split s LEFT JOIN told l ON l.doc_id = s.doc_id),
counts AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM failed GROUP BY part, fails),
orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) f(x) WHERE NOT contains(o, x)),
steps AS (
  SELECT o AS filter_order, i AS step, substr(o, i, 1) AS own, substr(o, 1, i - 1) AS before
  FROM orders, range(1, 6) r(i) WHERE length(o) = 5),
met AS (
  SELECT c.*, s.*, contains(c.fails, s.own) AS has, length(translate(c.fails, s.before, '')) < length(c.fails) AS gone
  FROM counts c, steps s),
audited AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT has AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN has AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN has AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN has AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN has AND NOT gone THEN bad ELSE 0 END) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM audited"""


#: CRC-32 of an ASCII string, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT)),
  lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384::BIGINT * (r & 1)))), 4294967295::BIGINT)"""

#: The repair as a shortest path over the rows, with one row for each state reached after each row.
TURN_REPAIR = rf"""
WITH RECURSIVE told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
hashed AS (SELECT *, {_CRC} % 20 AS fault FROM told),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, left(role, 1) AS initial, regexp_replace(text, '[ 	-]+$', '') AS whole,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faults AS (
  SELECT *, CASE WHEN whole = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN right(whole, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed),
-- before, after, edit, cost, initial that is needed (null: any)
edits(p, q, e, cost, needs) AS (
  VALUES ('0', '0', 'D', 3, NULL), ('s', 's', 'D', 3, NULL), ('u', 'u', 'D', 3, NULL), ('a', 'a', 'D', 3, NULL),
         ('0', 's', 'K', 0, 's'), ('0', 'u', 'K', 0, 'u'), ('s', 'u', 'K', 0, 'u'), ('a', 'u', 'K', 0, 'u'), ('u', 'a', 'K', 0, 'a'),
         ('0', 'u', 'R', 2, NULL), ('s', 'u', 'R', 2, NULL), ('a', 'u', 'R', 2, NULL), ('u', 'a', 'R', 2, NULL)),
-- insertions between two rows that can be of use
inserts(p, q, e, cost) AS (
  VALUES ('0', '0', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0), ('0', 'u', 'I', 2), ('0', 'a', 'II', 4),
         ('s', 'u', 'I', 2), ('s', 'a', 'II', 4), ('u', 'a', 'I', 2), ('a', 'u', 'I', 2)),
paths AS (
  SELECT DISTINCT conv, 0::BIGINT AS i, q AS at, {{'cost': x.cost, 'audit': x.e}} AS best FROM faults, inserts x WHERE x.p = '0'
  UNION ALL
  SELECT f.conv, f.i, x.q, min({{'cost': s.best.cost + d.cost + x.cost + CASE WHEN f.fault = 't' AND d.e <> 'D' THEN 1 ELSE 0 END,
                               'audit': s.best.audit || d.e || x.e}})
  FROM paths s JOIN faults f ON f.conv = s.conv AND f.i = s.i + 1
  JOIN edits d ON d.p = s.at AND (d.needs IS NULL OR d.needs = f.initial) AND (d.e = 'D' OR f.fault NOT IN ('b', 'd'))
  JOIN inserts x ON x.p = d.q GROUP BY f.conv, f.i, x.q),
sizes AS (SELECT conv, any_value(conv_id) AS conv_id, max(i) AS n, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                 count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
                 coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM faults GROUP BY conv),
final AS (
  SELECT z.conv, min(p.best) AS best FROM sizes z JOIN paths p ON p.conv = z.conv AND p.i = z.n AND p.at IN ('0', 'a') GROUP BY z.conv),
-- one edit a row, with the insertions before it; what is left stands behind the last row
steps AS (
  SELECT f.conv, unnest(regexp_extract_all(best.audit, 'I*[DKR]|I+$')) AS step, generate_subscripts(regexp_extract_all(best.audit, 'I*[DKR]|I+$'), 1) AS i
  FROM final f),
single AS (
  SELECT conv, i, unnest(string_split(step, '')) AS e, generate_subscripts(string_split(step, ''), 1) AS k FROM steps),
kept AS (
  SELECT s.conv, s.i, s.k, s.e, f.role, f.text, row_number() OVER (PARTITION BY s.conv ORDER BY s.i, s.k)
         - max(CASE WHEN s.e = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv) AS nth
  FROM single s LEFT JOIN faults f ON f.conv = s.conv AND f.i = s.i WHERE s.e <> 'D'),
lines AS (
  SELECT conv, string_agg(CASE WHEN e = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END,
                          chr(10) ORDER BY i, k) AS said FROM kept GROUP BY conv),
found AS (
  SELECT z.*, f.best, l.said FROM sizes z JOIN final f ON f.conv = z.conv LEFT JOIN lines l ON l.conv = z.conv)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM c.conv_id"""
