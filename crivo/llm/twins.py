"""SQL twins of queries that SQL can express over whole tables."""

#: Byte strings as pairs of hex digits, windows by md5 of 800 of them. Texts are
#: taken a thousand bytes at a time, or finding a place in a long one would cost more
#: than reading it.
SUFFIX_DEDUP = r"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS n, doc_id, hex(coalesce(text, '')) AS h FROM documents),
blocks AS (SELECT n, b, substr(h, b * 2000 + 1, 2800) AS part FROM
  (SELECT n, h, unnest(range(0, length(h) // 2000 + 1)) AS b FROM texts WHERE length(h) >= 800)),
windows AS MATERIALIZED (SELECT n, b * 1000 + i AS p, md5_number(substr(part, 2 * i + 1, 800)) AS k FROM
  (SELECT n, b, part, unnest(range(0, least(1000, length(part) // 2 - 399))) AS i FROM blocks)),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
hits AS (SELECT n, p, lag(p) OVER (PARTITION BY n ORDER BY p) AS before FROM windows SEMI JOIN twice USING (k)),
runs AS (SELECT n, p, sum(CASE WHEN before >= p - 400 THEN 0 ELSE 1 END) OVER (PARTITION BY n ORDER BY p) AS run FROM hits),
spans AS MATERIALIZED (SELECT n, min(p) AS start, max(p) + 400 AS stop FROM runs GROUP BY n, run),
gaps AS (SELECT n, start, lag(stop, 1, 0) OVER (PARTITION BY n ORDER BY start) AS since FROM spans
  UNION ALL SELECT n, length(any_value(h)) // 2, max(stop) FROM spans JOIN texts USING (n) GROUP BY n),
kept AS (SELECT n, string_agg(substr(h, 2 * since + 1, 2 * (start - since)), '' ORDER BY start) AS h FROM gaps JOIN texts USING (n) GROUP BY n),
removed AS (SELECT n, count(*) AS n_spans, sum(stop - start) AS n_removed FROM spans GROUP BY n)
SELECT doc_id, (length(t.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN removed USING (n) LEFT JOIN kept USING (n)
"""

#: crc32 goes byte by byte over all distinct features at once, by a table made from
#: its polynomial.
RESAMPLING = r"""
WITH RECURSIVE
table_bits(b, k, c) AS (SELECT range::UINTEGER, 0, range::UINTEGER FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END FROM table_bits WHERE k < 8),
crc_table AS MATERIALIZED (SELECT b, c FROM table_bits WHERE k = 8),
texts AS (SELECT 1 AS raw, row_number() OVER () AS n, doc_id, text FROM documents
  UNION ALL SELECT 0, row_number() OVER (), NULL, text FROM benchmark),
split AS MATERIALIZED (SELECT raw, n, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT raw, n, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM split),
held AS MATERIALIZED (SELECT raw, n, f, count(*) AS times FROM runs GROUP BY ALL),
names AS MATERIALIZED (SELECT f, hex(f) AS h, row_number() OVER () AS id FROM (SELECT DISTINCT f FROM held)),
walk(id, h, c) AS (SELECT id, h, 4294967295::UINTEGER FROM names
  UNION ALL SELECT id, substr(h, 3), xor(walk.c >> 8, t.c) FROM walk JOIN crc_table t
    ON t.b = xor(walk.c & 255, ('0x' || substr(h, 1, 2))::UINTEGER) WHERE h <> ''),
bucket_of AS MATERIALIZED (SELECT f, (xor(walk.c, 4294967295::UINTEGER) % 10000)::INT AS bucket FROM walk JOIN names USING (id) WHERE walk.h = ''),
counted AS (SELECT bucket, coalesce(sum(times) FILTER (raw = 1), 0) AS s, coalesce(sum(times) FILTER (raw = 0), 0) AS t
  FROM held JOIN bucket_of USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counted),
gains AS (SELECT bucket, floor(1000e0 * ln((t + 1e0) * (s_all + 10000e0) / ((s + 1e0) * (t_all + 10000e0))))::BIGINT AS gain
  FROM counted, totals),
weights AS (SELECT n, sum(times * gain) AS weight FROM held JOIN bucket_of USING (f) JOIN gains USING (bucket) WHERE raw = 1 GROUP BY n),
scored AS (SELECT doc_id, len(w) AS n_words, len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) AS n_features,
  coalesce(weight, 0)::BIGINT AS weight,
  (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UINTEGER + 0.5e0) / 4294967296e0 AS u
  FROM split LEFT JOIN weights USING (n) WHERE raw = 1),
noisy AS (SELECT *, weight + floor(-1000e0 * ln(-ln(u)))::BIGINT AS score FROM scored),
placed AS (SELECT *, row_number() OVER (ORDER BY n_words >= 20 DESC, score DESC, doc_id) AS place,
  count(*) FILTER (n_words >= 20) OVER () * 5 // 100 AS drawn FROM noisy)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= drawn THEN place::BIGINT END AS rank FROM placed
"""
