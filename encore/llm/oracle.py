"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from encore.llm.mixing import PART_RATE, TABLE

OP1 = r"""
WITH toks AS (
  SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS p FROM (
    SELECT doc_id, regexp_extract_all(text, '[ \t\n\r\f\v]*[^ \t\n\r\f\v]+[ \t\n\r\f\v]*') AS t FROM documents WHERE length(text) > 0)),
words AS (
  SELECT *, lower(regexp_replace(tok, '[ \t\n\r\f\v]+', '', 'g')) AS w, regexp_matches(tok, '([.!?][ \t\n\r\f\v]+|\n[ \t\n\r\f\v]*)$') AS ends FROM toks),
sentences AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM words),
numbered AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS m, row_number() OVER (PARTITION BY doc_id, k ORDER BY p) AS q FROM sentences),
picked AS (
  SELECT doc_id, m, q, min(lpad((999999999 - strlen(w))::VARCHAR, 9, '0') || w || lpad((999999999 - p)::VARCHAR, 9, '0'))
           OVER (PARTITION BY doc_id, k ORDER BY p ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS least
  FROM numbered WHERE m > 12),
anchors AS (SELECT DISTINCT doc_id, 999999999 - right(least, 9)::BIGINT AS p FROM picked WHERE q <= m - 11),
cut AS (
  SELECT n.doc_id, n.p, tok, w, ends,
         coalesce(sum((ends OR a.p IS NOT NULL)::INT) OVER (PARTITION BY n.doc_id ORDER BY n.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u
  FROM numbered n LEFT JOIN anchors a ON n.doc_id = a.doc_id AND n.p = a.p),
listed AS (
  SELECT doc_id, u, string_agg(w, ' ' ORDER BY p) AS norm, string_agg(tok, '' ORDER BY p) AS raw, count(*) AS n, bool_or(ends) AS ends
  FROM cut GROUP BY doc_id, u),
units AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY u) AS after, sum(length(raw)) OVER (PARTITION BY doc_id ORDER BY u) AS b FROM listed),
wholes AS (SELECT doc_id, list(norm ORDER BY u) AS norms, sum(n) AS n, max(u) AS last FROM units GROUP BY doc_id),
near AS (
  SELECT x.doc_id, x.u AS i, y.u AS j, y.ends OR y.u = max(y.u) OVER (PARTITION BY x.doc_id) AS ends
  FROM (SELECT *, unnest(range(25)) AS d FROM units) x JOIN units y ON x.doc_id = y.doc_id AND y.u = x.u + x.d
  WHERE y.after - (x.after - x.n) >= 25),
stretches AS (
  SELECT doc_id, i, min(j) AS j FROM near GROUP BY doc_id, i
  UNION SELECT doc_id, max(i) AS i, j FROM near WHERE ends GROUP BY doc_id, j
  UNION SELECT doc_id, 0, last FROM wholes WHERE n < 25),
texts AS (
  SELECT s.doc_id, i, j, array_to_string(norms[i::BIGINT + 1:j::BIGINT + 1], ' ') AS content FROM stretches s JOIN wholes USING (doc_id)),
firsts AS (SELECT content, min((doc_id, i)) AS first FROM texts GROUP BY content),
again AS (SELECT doc_id, i, j FROM texts JOIN firsts USING (content) WHERE (doc_id, i) > first),
gone AS (SELECT DISTINCT doc_id, unnest(range(i::BIGINT, j::BIGINT + 1)) AS u FROM again),
runs AS (
  SELECT g.doc_id, b - length(raw) AS a, b, g.u - row_number() OVER (PARTITION BY g.doc_id ORDER BY g.u) AS run
  FROM gone g JOIN units t ON g.doc_id = t.doc_id AND g.u = t.u),
spans AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM runs GROUP BY doc_id, run),
totals AS (
  SELECT doc_id, sum(b - a) AS n, string_agg(a::BIGINT || '-' || b::BIGINT, ',' ORDER BY a) AS removed FROM spans GROUP BY doc_id),
pieces AS (
  SELECT t.doc_id, string_agg(raw, '' ORDER BY t.u) AS text
  FROM units t LEFT JOIN gone g ON t.doc_id = g.doc_id AND t.u = g.u WHERE g.u IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(length(d.text), 0)::BIGINT AS n_chars, coalesce(t.n, 0)::BIGINT AS n_removed, coalesce(t.removed, '') AS removed,
       CASE WHEN t.doc_id IS NULL THEN d.text ELSE coalesce(p.text, '') END AS text
FROM documents d LEFT JOIN totals t ON d.doc_id = t.doc_id LEFT JOIN pieces p ON d.doc_id = p.doc_id
"""

OP2 = f"""
WITH stats AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
sums AS (SELECT sum(sqrt(n)) AS w, sum(n) AS total FROM stats),
rates AS (
  SELECT source, sqrt(n) / w * total::DOUBLE / n AS rate FROM stats, sums),
parts AS (SELECT source, rate, greatest(ceil(rate / {PART_RATE})::INT, 1) AS parts FROM rates),
terms AS (
  SELECT source, k, exp(-(rate / parts) + k * ln(rate / parts) - lgamma(k + 1)) AS p
  FROM parts, unnest(range({TABLE + 1})) AS r(k)),
tables AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
points AS (
  SELECT d.*, rate, j, ('0x' || substr(md5('11|' || doc_id::VARCHAR || '|' || j), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, parts + 1)) AS q(j)),
draws AS (
  SELECT p.doc_id, (SELECT count(*) FROM tables t WHERE t.source IS NOT DISTINCT FROM p.source AND t.c <= p.u) AS x FROM points p),
copies AS (SELECT doc_id, sum(x)::INT AS copies FROM draws GROUP BY doc_id)
SELECT d.*, rate, copies, copy::INT AS copy, md5('11|order|' || doc_id::VARCHAR || '|' || copy) AS shuffle_key
FROM documents d JOIN copies USING (doc_id) JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, copies + 1)) AS q(copy)
"""

OP3 = r"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
beside AS (
  SELECT row_number() OVER w AS k, doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following
  FROM base WINDOW w AS (ORDER BY doc_id NULLS FIRST, text)),
edits AS (
  SELECT *, left(text, length(text) - length(text) // 2) || left(following, length(text) // 2) AS edited FROM beside),
texts AS (
  SELECT k, 1 AS v, text AS t FROM edits UNION ALL SELECT k, 2, edited FROM edits UNION ALL SELECT k, 3, following FROM edits),
paragraphs AS (
  SELECT k, v, unnest(string_split(t, chr(10))) AS p, generate_subscripts(string_split(t, chr(10)), 1) AS i, len(string_split(t, chr(10))) AS m FROM texts),
cuts AS (
  SELECT k, v, i, m, string_split(regexp_replace(regexp_replace(p, '([.!?]+[ \t\r\f]+|[^ \t\r\f]{10}[ \t\r\f]+)', '\1' || chr(1), 'g'),
                                  '([^\x01]{256})', '\1' || chr(1), 'g'), chr(1)) AS s FROM paragraphs),
leaves AS (
  SELECT k, v, i, j, md5(s[j]) || '-' || length(s[j]) AS h, length(s[j]) + CASE WHEN j = len(s) AND i < m THEN 1 ELSE 0 END AS n
  FROM cuts, unnest(range(1, len(s) + 1)) AS r(j)),
digests AS (SELECT k, v, i, md5(string_agg(h, ',' ORDER BY j)) AS d FROM leaves GROUP BY k, v, i),
numbered AS (
  SELECT *, coalesce(sum(CASE WHEN d < '4' THEN 1 ELSE 0 END) OVER (PARTITION BY k, v ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM digests),
sections AS (SELECT k, v, s, md5(string_agg(d || ',', '' ORDER BY i)) AS d FROM numbered GROUP BY k, v, s),
roots AS (SELECT k, v, sha256(string_agg(d, ',' ORDER BY s)) AS fingerprint, count(*) AS n FROM sections GROUP BY k, v),
pairs AS (SELECT * FROM (VALUES (1, 2), (2, 1), (1, 3), (3, 1)) AS t(v, o)),
opened AS (
  SELECT l.k, l.v, p.o, l.j, l.i, l.h, l.n FROM leaves l JOIN digests g USING (k, v, i) JOIN pairs p USING (v)
  WHERE NOT EXISTS (SELECT 1 FROM digests x WHERE x.k = l.k AND x.v = p.o AND x.d = g.d)),
changed AS (
  SELECT k, v, o, i, j, h, n FROM opened a
  WHERE NOT EXISTS (SELECT 1 FROM opened b WHERE b.k = a.k AND b.v = a.o AND b.o = a.v AND b.h = a.h)),
amounts AS (SELECT k, v, o, sum(h[34:]::INT) AS n FROM (SELECT DISTINCT k, v, o, h FROM changed) GROUP BY k, v, o),
sizes AS (SELECT k, v, sum(h[34:]::INT) AS n FROM (SELECT DISTINCT k, v, h FROM leaves) GROUP BY k, v),
places AS (
  SELECT k, v, i, j, n, sum(n) OVER w AS stop, row_number() OVER w AS r FROM leaves WHERE n > 0 WINDOW w AS (PARTITION BY k, v ORDER BY i, j)),
islands AS (
  SELECT k, v, o, stop - n AS start, stop, r - row_number() OVER (PARTITION BY k, v, o ORDER BY r) AS island
  FROM changed JOIN places USING (k, v, i, j, n) WHERE o + v = 3),
spans AS (SELECT k, v, min(start) AS start, max(stop) AS stop FROM islands GROUP BY k, v, island),
lists AS (SELECT k, v, string_agg(start::BIGINT || '-' || stop::BIGINT, ',' ORDER BY start) AS spans FROM spans GROUP BY k, v)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, f.fingerprint, g.fingerprint AS edited_fingerprint,
       CASE WHEN s.n + t.n = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - (coalesce(a.n, 0) + coalesce(b.n, 0))::DOUBLE / (s.n + t.n) END AS near_edited,
       CASE WHEN s.n + u.n = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - (coalesce(c.n, 0) + coalesce(d.n, 0))::DOUBLE / (s.n + u.n) END AS near_next,
       f.n::INT AS n_sections, coalesce(x.spans, '') AS removed, coalesce(y.spans, '') AS added
FROM edits e JOIN roots f ON f.k = e.k AND f.v = 1 JOIN roots g ON g.k = e.k AND g.v = 2
JOIN sizes s ON s.k = e.k AND s.v = 1 JOIN sizes t ON t.k = e.k AND t.v = 2 JOIN sizes u ON u.k = e.k AND u.v = 3
LEFT JOIN amounts a ON a.k = e.k AND a.v = 1 AND a.o = 2 LEFT JOIN amounts b ON b.k = e.k AND b.v = 2 AND b.o = 1
LEFT JOIN amounts c ON c.k = e.k AND c.v = 1 AND c.o = 3 LEFT JOIN amounts d ON d.k = e.k AND d.v = 3 AND d.o = 1
LEFT JOIN lists x ON x.k = e.k AND x.v = 1 LEFT JOIN lists y ON y.k = e.k AND y.v = 2
"""

OP5 = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS x, least(13, len(w)) AS n
  FROM item_words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
spots AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM doc_words, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS r(i) WHERE len(w) >= n),
hits AS (SELECT DISTINCT doc_id, i, s.n, item_id FROM spots s JOIN windows v ON s.x = v.x AND s.n = v.n),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM hits),
runs AS (SELECT doc_id, k, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS g FROM places),
spans AS (SELECT doc_id, min(k) - 1 AS a, max(k) AS b FROM runs GROUP BY doc_id, g),
per_doc AS (SELECT doc_id, sum(b - a)::BIGINT AS n_hit, string_agg(a || '-' || b, ',' ORDER BY a) AS spans FROM spans GROUP BY doc_id),
per_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(spans, '') AS spans
FROM doc_words d LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_items USING (doc_id)
"""

OP9 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
said AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS escaped,
         replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS escaped_role FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || escaped_role || chr(10) || escaped || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""

_ROUND = """
d{i} AS (
  SELECT rid, c, list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept k, c{i} m),
a{i} AS (SELECT rid, min((d, c)) AS near FROM d{i} GROUP BY rid),
"""
_MEAN = """
s{i} AS (
  SELECT c, j, sum(x)::HUGEINT AS s, count(*) AS n FROM (
    SELECT near[2] AS c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i} JOIN kept USING (rid)) GROUP BY c, j),
m{i} AS (SELECT c, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY j) AS v FROM s{i} GROUP BY c),
c{j} AS (SELECT c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m USING (c)),
"""

OP11 = """
WITH finite AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
kept AS MATERIALIZED (SELECT rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM finite),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT 16)),
""" + "".join(_ROUND.format(i=i) + _MEAN.format(i=i, j=i + 1) for i in range(3)) + _ROUND.format(i=3) + """
sums AS (SELECT near[2] AS c, sum(near[1])::BIGINT AS s FROM a3 GROUP BY c)
SELECT k.vec_id, a.near[2]::INT AS cluster, a.near[1]::BIGINT AS distance, s.s AS cluster_inertia, (SELECT sum(s) FROM sums)::BIGINT AS inertia,
       sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a3 a JOIN kept k USING (rid) JOIN sums s ON s.c = a.near[2] JOIN c3 m ON m.c = a.near[2]
"""

OP12 = """
WITH held AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
groups AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper, sha1(html) AS h FROM held)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       list_aggregate(flatten(list_transform(range(8), lambda g: list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (5 * g + 1)::INT, 5))::BIGINT >> s) & 31)::INT + 1, 1)))), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM groups
"""

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op2_mix_sources": OP2,
    "op3_fingerprints": OP3,
    "op5_decontaminate": OP5,
    "op9_format_chats": OP9,
    "op11_centroid_clusters": OP11,
    "op12_warc": OP12,
}
