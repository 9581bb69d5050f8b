"""SQL for the registered queries that SQL can express, from the base tables alone."""

from __future__ import annotations

_SHINGLES = """
CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
     ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END"""

# every window of 400 bytes as hex digits; one that occurs twice takes its bytes away
REPEATS = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), win AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 800)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS p FROM d WHERE n >= 400)
), hit AS (
  SELECT doc_id, p FROM win JOIN (SELECT m FROM win GROUP BY m HAVING count(*) > 1) USING (m)
), marked AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400, TRUE) AS fresh FROM hit
), numbered AS (
  SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
), runs AS (
  SELECT doc_id, run, min(p) AS a, max(p) + 400 AS b FROM numbered GROUP BY doc_id, run
), edges AS (
  SELECT runs.*, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM runs
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
  FROM edges JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct({_SHINGLES})) AS x FROM t
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r
), least_id AS (
  SELECT d, min(r) AS component_id FROM reach GROUP BY d
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least_id ON d = doc_id LEFT JOIN n USING (doc_id)"""

CONTAINMENT = rf"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), t AS (
  SELECT side, id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM words
), s AS (
  SELECT side, id, list_distinct({_SHINGLES}) AS xs FROM t
), item AS (
  SELECT id AS item_id, len(xs) AS n_item, unnest(xs) AS x FROM s WHERE side = 'i'
), doc AS (
  SELECT id AS doc_id, unnest(xs) AS x FROM s WHERE side = 'd'
)
SELECT doc_id, item_id, any_value(n_item)::BIGINT AS n_item, count(*) AS n_shared
FROM doc JOIN item USING (x) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n_item)"""

NEAREST = """
WITH c AS (
  SELECT vec_id AS id, list_sum(list_transform(range(64), lambda i: CASE WHEN embedding[i + 1] > 0 THEN 1::HUGEINT << i ELSE 0::HUGEINT END))::UBIGINT AS code
  FROM embeddings
), far AS (
  SELECT q.id AS query_id, c.id AS id, bit_count(xor(q.code, c.code))::INT AS distance
  FROM c q JOIN c ON q.id % 50 = 0 AND q.id <> c.id
)
SELECT query_id, id, distance, (row_number() OVER (PARTITION BY query_id ORDER BY distance, id))::INT AS rank
FROM far QUALIFY rank <= 10"""

RESAMPLED = r"""
WITH f AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), bytes AS (
  -- crc32 of each word, byte by byte, over its hex digits
  SELECT w, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS c
  FROM (SELECT DISTINCT w FROM f)
), h AS (
  SELECT side, id, xor(c, 4294967295) % 10000 AS bucket FROM f JOIN bytes USING (w)
), counts AS (
  SELECT b AS bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
  FROM range(10000) r(b) LEFT JOIN h ON h.bucket = b GROUP BY b
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
), weights AS (
  SELECT id AS doc_id, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight FROM h JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked"""

WORD_REPEATS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, p, md5(array_to_string(w[p : p + 34], ' ')) AS m FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)
), hit AS (
  SELECT doc_id, p, TRUE AS again FROM win JOIN (SELECT m FROM win GROUP BY m HAVING count(*) > 1) USING (m)
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), marked AS (
  SELECT doc_id, word, p, coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), FALSE) AS gone
  FROM words LEFT JOIN hit USING (doc_id, p)
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS k FROM marked GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

LLM_ORACLES = {
    "op1_suffix_dedup": REPEATS,
    "op6_benchmark_containment": CONTAINMENT,
    "op9_minhash_near_dedup": NEAR_DUPLICATES,
    "op10_exact_topk": NEAREST,
    "op11_importance_resampling": RESAMPLED,
    "op13_anchor_dedup": WORD_REPEATS,
}
