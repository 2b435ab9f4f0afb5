"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

OP2 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
r AS (
  SELECT payload, min(page_id) AS first_id FROM p GROUP BY payload)
SELECT p.page_id,
  CAST(strlen(p.payload) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(p.h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN p.page_id = r.first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id = r.first_id THEN NULL ELSE r.first_id END AS refers_to
FROM p JOIN r ON p.payload = r.payload
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    substr(md5('mix:' || md5(coalesce(CAST(doc_id AS VARCHAR), '')) || md5(coalesce(text, ''))), 1, 12) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS BIGINT) AS w
  FROM d GROUP BY source),
-- Sources by how soon they reach three times their size; the first k of them are cut.
o AS (
  SELECT *, row_number() OVER (ORDER BY source_size * 1.0 / w, source NULLS LAST) AS k,
    (SELECT sum(source_size) FROM s) AS words, (SELECT sum(w) FROM s) AS weights
  FROM s),
c AS (
  SELECT *,
    words - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
    weights - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM o),
f AS (
  SELECT CAST(left_words AS DOUBLE) AS left_words, CAST(left_weight AS DOUBLE) AS left_weight, k AS first_open
  FROM c WHERE NOT CAST(w AS DOUBLE) * CAST(left_words AS DOUBLE) / CAST(left_weight AS DOUBLE) > 3 * source_size
  ORDER BY k LIMIT 1),
t AS (
  SELECT c.source, c.source_size,
    CASE WHEN f.first_open IS NULL OR c.k < f.first_open THEN CAST(3 * c.source_size AS DOUBLE)
      ELSE CAST(c.w AS DOUBLE) * f.left_words / f.left_weight END AS target
  FROM c LEFT JOIN f ON true),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 3) AS BIGINT) ELSE 0 END AS rounds
  FROM t),
-- Documents of one hash go together; those whose running sum stays within the rest are taken once more.
g AS (
  SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
r AS (
  SELECT g.source, g.h, g.words, b.target - b.rounds * b.source_size AS rest,
    sum(g.words) OVER (PARTITION BY g.source ORDER BY g.h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM g JOIN b ON g.source IS NOT DISTINCT FROM b.source),
x AS (
  SELECT source, h, upto <= rest OR (upto - words <= rest AND 2 * (rest - (upto - words)) > words) AS more, rest FROM r)
SELECT d.doc_id, d.size, b.source_size AS source_size, b.target,
  CAST(d.size * (b.rounds + CASE WHEN x.more AND x.rest > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
"""


OP11 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, w, least(10, len(w)) AS l FROM (
    SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark)
  WHERE len(w) > 0),
items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, l, array_to_string(w[k + 1 : k + l], ' ') AS phrase
  FROM (SELECT item_id, w, l, unnest(range(len(w) - l + 1)) AS k FROM b)),
lengths AS (SELECT DISTINCT l FROM items),
places AS (
  SELECT doc_id, l, k, array_to_string(w[k + 1 : k + l], ' ') AS phrase
  FROM (SELECT doc_id, w, l, unnest(range(greatest(len(w) - l + 1, 0))) AS k FROM d, lengths)),
hits AS (SELECT p.doc_id, p.k, p.l, i.item FROM places p JOIN items i ON p.l = i.l AND p.phrase = i.phrase),
words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + l)) AS place FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(found.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(found.listed, '')) AS items_sha256,
  coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""


OP12 = r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
target AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
runs AS (SELECT unnest([1, 2, 3]) AS l),
doc_runs AS (
  SELECT doc_id, array_to_string(w[k + 1 : k + l], ' ') AS f, count(*) AS n
  FROM (SELECT doc_id, w, l, unnest(range(greatest(len(w) - l + 1, 0))) AS k FROM fold, runs) GROUP BY ALL),
target_runs AS (
  SELECT array_to_string(w[k + 1 : k + l], ' ') AS f, count(*) AS n
  FROM (SELECT w, l, unnest(range(greatest(len(w) - l + 1, 0))) AS k FROM target, runs) GROUP BY ALL),
-- The table of CRC-32 by its polynomial, then byte after byte.
crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda x, y:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(hex(f)), 2),
      lambda i: CAST('0x' || substr(hex(f), CAST(i + 1 AS BIGINT), 2) AS BIGINT))), lambda x, y:
    xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT f FROM doc_runs UNION SELECT f FROM target_runs), crc_table),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM doc_runs JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS t FROM target_runs JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT s.bucket, CAST(floor(1000 * ln(
    (coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT sum(s) FROM s)::DOUBLE + 10000)
    / ((s + 1.0::DOUBLE) * (coalesce((SELECT sum(t) FROM t), 0)::DOUBLE + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON s.bucket = t.bucket),
weights AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM doc_runs JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT fold.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || fold.doc_id), 1, 8) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM fold LEFT JOIN weights ON fold.doc_id = weights.doc_id),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_words >= 20)
SELECT scored.doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT 5 * count(*) // 100 FROM placed) THEN place END AS rank
FROM scored LEFT JOIN placed ON scored.doc_id = placed.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc_archive": OP2,
        "op8_source_mix": OP8,
        "op11_fm_decontamination": OP11,
        "op12_importance_resampling": OP12,
    }
