"""SQL (DuckDB) for the text queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_decontaminate"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS seq
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS seq
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM words CROSS JOIN sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, s, p.size, item_id FROM places p JOIN windows x ON p.seq = x.seq AND p.size = x.size),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(s, s + size)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(i.names, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

ORACLE["op3_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON e.vec_id = least.x LEFT JOIN degree ON e.vec_id = degree.x
"""

ORACLE["op4_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
FROM p
"""

ORACLE["op8_rollups"] = r"""
WITH texts AS (
  SELECT source, lang, coalesce(CASE WHEN lang = 'de' THEN regexp_replace(text, '[0-9]', '', 'g') ELSE text END, '') AS t,
    CASE WHEN source = 'src3' THEN 0 ELSE 1 END AS alive
  FROM documents),
counts AS (
  SELECT source, lang, 'words.1' AS tokenizer, alive, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n FROM texts
  UNION ALL
  SELECT source, lang, 'words.2', alive, len(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM texts)
SELECT source, lang, tokenizer, CAST(sum(alive) AS BIGINT) AS docs, CAST(sum(alive * n) AS BIGINT) AS tokens
FROM counts GROUP BY source, lang, tokenizer
"""

ORACLE["op5_recompression"] = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM words WHERE len(w) >= 50)),
first AS (SELECT seq, min(doc_id) AS least FROM places GROUP BY seq HAVING min(doc_id) < max(doc_id)),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS k FROM places JOIN first USING (seq) WHERE least < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n FROM each ANTI JOIN covered USING (doc_id, k) GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

ORACLE["op10_bwt"] = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
places AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 100)) AS seq
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS s FROM bytes WHERE n >= 50)),
first AS (SELECT seq, min(doc_id) AS least FROM places GROUP BY seq HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, s FROM places JOIN first USING (seq) WHERE least < doc_id),
starts AS (SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 50, true) AS new FROM hit),
runs AS (SELECT doc_id, s, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM starts),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM runs GROUP BY doc_id, r),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS h
  FROM gaps g JOIN bytes USING (doc_id) GROUP BY g.doc_id),
lost AS (SELECT doc_id, sum(b - a) AS n, count(*) AS k FROM spans GROUP BY doc_id)
SELECT bytes.doc_id, CAST(bytes.n AS BIGINT) AS n_bytes, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept.h, bytes.h))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

ORACLE["op13_lexical"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
asked AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(w) AS term FROM b) GROUP BY q, item_id, term),
totals AS (SELECT count(*) AS docs, sum(len(w)) AS words FROM d WHERE len(w) > 0),
held AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, n, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held CROSS JOIN totals GROUP BY term, docs),
scores AS (
  SELECT q, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) CROSS JOIN totals GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""
