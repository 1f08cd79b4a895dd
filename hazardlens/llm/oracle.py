"""DuckDB SQL of the queries that SQL can express, over whole tables."""

SQL = {}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL["op4_substring_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
win AS (
  SELECT r, p, array_to_string(list_slice(w, p, p + 34), ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)
), again AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1
), gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS p FROM again),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d)
  WHERE (r, p) NOT IN (SELECT r, p FROM gone) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

SQL["op5_vector_search"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL["op13_line_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS p FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {AZ}) AS key FROM l),
big AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5
), judged AS (
  SELECT r, doc_id, line, p, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM k LEFT JOIN big USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""

TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op11_ranked_search"] = rf"""
WITH d AS (SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents) WHERE len(w) > 0),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), tf AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(m) AS m, term, count(*) AS tf
  FROM (SELECT r, doc_id, 25 + (75 * len(w) * n_docs) // n_terms AS m, unnest(w) AS term FROM d, corpus)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term
), scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term) GROUP BY item_id, r
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
