"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op5_warc_fixity": r"""
WITH records AS (
  SELECT page_id, html,
         concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10),
                'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10),
                'WARC-Target-URI: ', url, chr(13), chr(10),
                'WARC-Date: 2025-01-01T00:00:00Z', chr(13), chr(10),
                'Content-Type: text/html', chr(13), chr(10),
                'Content-Length: ', strlen(coalesce(html, '')), chr(13), chr(10), chr(13), chr(10),
                html, chr(13), chr(10), chr(13), chr(10)) AS record
  FROM pages),
placed AS (
  SELECT page_id, html, row_number() OVER (ORDER BY page_id) - 1 AS place,
         strlen(record) AS length, sha256(record) AS record_sha256
  FROM records),
filed AS (
  SELECT *, place // 4096 AS file,
         CAST(coalesce(sum(length) OVER (PARTITION BY place // 4096 ORDER BY place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM placed)
SELECT page_id, place, file, "offset", length, record_sha256,
       sha256(concat(file, ':', "offset", ':', record_sha256)) AS digest,
       CASE WHEN page_id % 211 = 17 THEN 'missing'
            WHEN page_id % 97 = 13 AND right(html, 1) <> '~' THEN 'corrupt' ELSE 'sound' END AS status
FROM filed
""",
    "op7_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, text,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> ''))
              AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, sum(size) AS source_size FROM docs GROUP BY source)),
levels AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source) AS place,
         (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER earlier, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM sources
  WINDOW earlier AS (ORDER BY source_size / weight, source
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- The share per weight once all sources that it would fill beyond their limit are at the limit.
share AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= 3 * source_size),
aims AS (
  SELECT source, source_size, least(3.0 * source_size, share.level * weight) AS target
  FROM sources, share),
quotas AS (
  SELECT *, least(3 * source_size, CAST(floor(target + 0.5) AS BIGINT)) AS quota FROM aims),
streams AS (
  SELECT docs.*, source_size, target, quota,
         sum(size) OVER (PARTITION BY docs.source ORDER BY md5('mix:' || CAST(doc_id AS VARCHAR)), doc_id)
           - size AS start
  FROM docs JOIN quotas ON docs.source IS NOT DISTINCT FROM quotas.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
       CAST(list_sum(list_transform([0, 1, 2], lambda e:
         least(e * source_size + start + size, quota) - least(e * source_size + start, quota)))
         AS BIGINT) AS taken
FROM streams
""",
    "op8_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS number
  FROM documents),
split AS (
  SELECT doc_id, number, list_filter(regexp_split_to_array(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[ \t-\r]+'), lambda w: w <> '') AS words
  FROM lines),
sets AS (
  SELECT doc_id, number, list_distinct(words) AS words, len(list_distinct(words)) AS n
  FROM split WHERE len(words) >= 1),
used AS (SELECT word, count(*) AS uses FROM (SELECT unnest(words) AS word FROM sets) GROUP BY word),
-- Two sets of that likeness share one of their rarest words, n - ceil(0.8 n) + 1 of each.
ranked AS (
  SELECT doc_id, number, n, word, row_number() OVER (PARTITION BY doc_id, number ORDER BY uses, word) AS place
  FROM (SELECT doc_id, number, n, unnest(words) AS word FROM sets) JOIN used USING (word)),
rare AS (SELECT * FROM ranked WHERE place <= n - (n * 80 + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.doc_id, a.number, b.doc_id AS other_id, b.number AS other_number
  FROM rare a JOIN rare b ON a.word = b.word AND (b.doc_id, b.number) < (a.doc_id, a.number)
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
gone AS (
  SELECT DISTINCT pairs.doc_id, pairs.number
  FROM pairs JOIN sets a ON a.doc_id = pairs.doc_id AND a.number = pairs.number
    JOIN sets b ON b.doc_id = other_id AND b.number = other_number
  WHERE 180 * len(list_intersect(a.words, b.words)) >= 80 * (a.n + b.n)),
rest AS (
  SELECT lines.doc_id, count(gone.number) AS lines_removed,
         coalesce(string_agg(line, chr(10) ORDER BY lines.number) FILTER (gone.number IS NULL), '') AS text
  FROM lines LEFT JOIN gone ON gone.doc_id = lines.doc_id AND gone.number = lines.number
  GROUP BY lines.doc_id)
SELECT doc_id, lines_removed, length(text) AS n_chars_left, sha256(text) AS text_sha256 FROM rest
""",
    "op11_sorted_list_search": """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM vectors q JOIN vectors v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM pairs WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
""",
    "op13_phrase_graph": r"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\n-\r]')) AS piece FROM documents)),
grams AS (
  SELECT lang, m, array_to_string(words[i : i + m - 1], ' ') AS phrase
  FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m))),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
often AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase HAVING f >= 30),
cuts AS (
  SELECT lang, m, phrase, f AS a, k, string_split(phrase, ' ') AS words
  FROM often, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m),
parts AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, CAST(a AS HUGEINT) * 2000000 // (l.f + r.f) AS score
  FROM cuts c
  JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(words[1 : k], ' ')
  JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1 : c.m], ' ')),
weakest AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, array_to_string(words[i : i + size - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT lang, f, words, size, unnest(range(1, m - size + 2)) AS i
        FROM (SELECT lang, m, f, string_split(phrase, ' ') AS words FROM often),
             (SELECT unnest([2, 3]) AS size) WHERE size < m)
  GROUP BY ALL)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank,
       w.phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM weakest w JOIN totals USING (lang)
LEFT JOIN longer ON longer.lang = w.lang AND longer.phrase = w.phrase
WHERE NOT 100 * coalesce(longer.f, 0) >= 80 * a
QUALIFY rank <= 2000
""",
}
