"""DuckDB twins of the corpus queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS win
        FROM (SELECT item_id, ws, least(len(ws), 13) AS n FROM b WHERE len(ws) > 0), unnest(range(1, CAST(len(ws) - n + 2 AS BIGINT))) AS t(i)),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win FROM w, lens, unnest(range(1, CAST(len(ws) - n + 2 AS BIGINT))) AS t(i) WHERE len(ws) >= n),
hit AS (SELECT dw.doc_id, dw.i, dw.n, win.item_id FROM dw JOIN win USING (win, n)),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, CAST(n AS BIGINT))) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hit GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP3 = """
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (SELECT r, i, sha256(array_to_string(ws[i : i + 34], ' ')) AS win FROM w, unnest(range(1, CAST(len(ws) - 33 AS BIGINT))) AS t(i) WHERE len(ws) >= 35),
again AS (SELECT win FROM win GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS i FROM win SEMI JOIN again USING (win), unnest(range(0, 35)) AS t(k)),
places AS (SELECT r, i, ws[i] AS word FROM w, unnest(range(1, CAST(len(ws) + 1 AS BIGINT))) AS t(i)),
kept AS (SELECT p.r, p.i, p.word FROM places p LEFT JOIN gone g ON p.r = g.r AND p.i = g.i WHERE g.r IS NULL),
text AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM kept GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN text USING (r)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

OP11 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
q AS (SELECT item_id, row_number() OVER () AS i, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY ALL),
asked AS (SELECT i, term, count(*) AS k FROM (SELECT i, unnest(ws) AS term FROM q) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, size WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
part AS (SELECT tf.r, tf.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(ws) * n_docs) // n_terms))) AS worth
         FROM tf JOIN weight USING (term) JOIN d ON tf.r = d.r, size),
score AS (SELECT i, r, CAST(sum(k * worth) AS BIGINT) AS score FROM asked JOIN part USING (term) GROUP BY i, r),
ranked AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN q USING (i) WHERE rank <= 20
"""

SQL = {"op3_substring_dedup": OP3, "op4_decontamination": OP4, "op6_warc": OP6, "op11_lexical_search": OP11}
