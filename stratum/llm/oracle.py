"""DuckDB SQL for the queries of this package that SQL can express."""

OP2 = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS hash,
         row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1 AS number,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (
      ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM s),
-- The full sources are a prefix in the order of cap / weight.
o AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap,
         row_number() OVER (ORDER BY source_size * 3.0::DOUBLE / w, source NULLS LAST) AS k
  FROM r),
lv AS (
  SELECT *,
    (sum(source_size) OVER () ::DOUBLE
     - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM o),
-- The level of the first source, in that order, that is not full at it.
l AS (SELECT arg_min(level, k) AS level FROM lv WHERE w * level < cap),
t AS (
  SELECT source, source_size, least(cap, w * (SELECT level FROM l)) AS target FROM lv)
SELECT d.doc_id, d.size, t.source_size, t.target,
       (d.size * (floor(rate) + CASE WHEN
          ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.hash || ':'
                              || d.number), 1, 13))::BIGINT
          / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
             FROM t) t ON d.source IS NOT DISTINCT FROM t.source
"""

OP7 = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.r AS query, q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON c.r <> q.r AND len(c.e) = len(q.e)
  WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP10 = r"""
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first,
         row_number() OVER (PARTITION BY payload_digest
                            ORDER BY page_id NULLS LAST, url NULLS FIRST) AS r FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND r > 1 THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND r > 1 THEN first END AS refers_to
FROM f
"""

OP11 = r"""
-- The byte table of CRC-32, by eight shifts of its polynomial.
WITH RECURSIVE step(k, b, c) AS (
  SELECT 0, b, b FROM range(256) r(b)
  UNION ALL
  SELECT k + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8),
words AS (
  SELECT false AS goal, doc_id AS id, row_number() OVER () AS rn,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT true, item_id, row_number() OVER (),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark),
features AS (
  SELECT goal, rn, unnest(w) AS f FROM words
  UNION ALL
  SELECT goal, rn, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
  FROM words WHERE len(w) > 1),
per AS (SELECT goal, rn, f, count(*)::BIGINT AS n FROM features GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM per)),
bucket AS (
  SELECT f, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(len(x) // 2),
        lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
      lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS b
  FROM hexed, crc),
counts AS (
  SELECT b, coalesce(sum(n) FILTER (NOT goal), 0) AS s, coalesce(sum(n) FILTER (goal), 0) AS t
  FROM per JOIN bucket USING (f) GROUP BY b),
sums AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gain AS (
  SELECT b, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE)
                            / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g
  FROM counts, sums),
weights AS (
  SELECT rn, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS total
  FROM per JOIN bucket USING (f) JOIN gain USING (b) WHERE NOT goal GROUP BY rn),
scored AS (
  SELECT id AS doc_id, len(w) >= 20 AS able, coalesce(n_features, 0)::BIGINT AS n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
         floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(id::VARCHAR, 'null')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM words LEFT JOIN weights USING (rn) WHERE NOT goal),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY weight + noise DESC, doc_id NULLS LAST) AS r,
         25 * count(*) FILTER (able) OVER () // 100 AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, weight + noise AS score,
       CASE WHEN able AND r <= drawn THEN r END::BIGINT AS rank
FROM ranked
"""

ORACLE_SQL = {"op2_mix": OP2, "op7_topk": OP7, "op10_warc": OP10,
              "op11_importance_resample": OP11}
