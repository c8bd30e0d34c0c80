"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op10_exact_dedup"] = r"""
WITH k AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) = 1 AS kept,
       text_sha256
FROM k
"""

ORACLE["op7_url_filter"] = r"""
WITH c AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 366 AS INTEGER) AS fetch_day,
         lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]*/([a-z][a-z])/', 1) AS lang
  FROM pages
), p AS (
  SELECT page_id, host AS pattern, 'host' AS category FROM c
  UNION ALL SELECT page_id, host || '/' || lang, 'section' FROM c
  UNION ALL SELECT page_id, regexp_replace(host, '^[^.]*[.]', ''), 'parent' FROM c
), f AS (
  SELECT pattern, category, min(page_id) AS first FROM p
  GROUP BY ALL
), e AS (
  SELECT pattern, category, 'add' AS action, DATE '2024-01-01' + CAST((first * 31) % 200 AS INTEGER) AS day FROM f
  UNION ALL SELECT pattern, category, 'remove', DATE '2024-01-01' + CAST((first * 31) % 200 + 45 AS INTEGER) FROM f WHERE first % 2 = 0 AND pattern LIKE '%.%.%'
  UNION ALL SELECT pattern, category, 'remove', DATE '2024-01-01' + CAST((first * 31) % 200 + 9 AS INTEGER) FROM f WHERE pattern NOT LIKE '%.%.%'
  UNION ALL SELECT pattern, category, 'add', DATE '2024-01-01' + CAST((first * 31) % 200 + 90 AS INTEGER) FROM f WHERE first % 4 = 0 AND pattern LIKE '%.%.%'
), d AS (
  SELECT pattern, day, bool_and(action = 'add') AS listed, min(category) AS category FROM e GROUP BY ALL
), v AS (
  SELECT *, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS valid_to FROM d
), m AS (
  SELECT c.page_id, c.host, c.fetch_day, v.pattern, v.category, v.day AS since
  FROM c LEFT JOIN v ON v.listed AND c.fetch_day >= v.day AND (v.valid_to IS NULL OR c.fetch_day < v.valid_to)
    AND (v.pattern = c.host OR ends_with(c.host, '.' || v.pattern)
         OR (contains(v.pattern, '/') AND starts_with(regexp_replace(url, '^[a-z]+://', '') || '/', v.pattern || '/')))
)
SELECT page_id, host, fetch_day, count(pattern) > 0 AS blocked, count(pattern) AS n_active,
       first(pattern ORDER BY length(pattern) DESC NULLS LAST, pattern) AS pattern,
       first(category ORDER BY length(pattern) DESC NULLS LAST, pattern) AS category,
       first(since ORDER BY length(pattern) DESC NULLS LAST, pattern) AS listed_since
FROM m GROUP BY page_id, host, fetch_day
"""

ORACLE["op5_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, source, unnest(range(1, len(lines) + 1)) AS pos, lines FROM d
), b AS (
  SELECT doc_id, source, pos, lines[pos] AS line, trim(lines[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l
), t AS (
  SELECT source, count(*) AS total FROM (SELECT DISTINCT source, text FROM documents) GROUP BY source
), u AS (
  SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source, text
), r AS (
  SELECT b.source, b.bare FROM b JOIN u ON b.source IS NOT DISTINCT FROM u.source AND b.doc_id = u.doc_id
  JOIN t ON b.source IS NOT DISTINCT FROM t.source
  WHERE b.bare <> '' GROUP BY b.source, b.bare
  HAVING count(DISTINCT b.doc_id) >= 2 AND count(DISTINCT b.doc_id) > any_value(t.total) * 0.08
)
SELECT b.doc_id, count(*) FILTER (b.bare <> '') AS n_lines,
       count(*) FILTER (r.bare IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(b.line, chr(10) ORDER BY b.pos) FILTER (r.bare IS NULL), '')) AS kept_sha256
FROM b LEFT JOIN r ON b.source IS NOT DISTINCT FROM r.source AND b.bare = r.bare
GROUP BY b.doc_id
"""

ORACLE["op11_phrase_mining"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
         lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(ws) >= k
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k >= 2 AND f >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, candidates.k)) AS cut FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1:c.k], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, inside, max(a) AS most FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS inside
    FROM candidates WHERE k = 3) GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, phrase) AS rank,
       phrase, b.a, b.l, b.r, n, CAST(score AS BIGINT) AS score
FROM best b JOIN totals t ON t.lang = b.lang
LEFT JOIN longer w ON w.lang = b.lang AND w.inside = b.phrase
WHERE w.most IS NULL OR 100 * w.most < 50 * b.a
QUALIFY rank <= 2000
"""
