"""DuckDB SQL for the corpus queries that SQL can express."""

#: Base counts and shared lines (the limits are those of ``line_quality``).
OP3_LINE_QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), tokens AS (
  SELECT rid, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs
), windows AS (
  SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM tokens WHERE len(w) >= 3)
), repeats AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1
  ) GROUP BY rid
), lines AS (
  SELECT rid, host, text, line, trim(regexp_replace(lower(line), '[^\p{L}]+', ' ', 'g')) AS norm,
         len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT rid, host, text, unnest(string_split(text, chr(10))) AS line FROM docs)
), dups AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines WHERE n > 0 GROUP BY rid
), shared AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS c, max(n) AS longest FROM lines WHERE n > 0 AND norm <> '' GROUP BY host, norm)
  JOIN (SELECT host, count(DISTINCT text) AS host_docs FROM docs GROUP BY host) USING (host)
  WHERE c > 5 AND c > 0.05 * host_docs OR c >= 100 OR longest >= 50 AND c > 3
), lost AS (
  SELECT rid, count(*) AS removed_lines, sum(n) AS removed_words FROM lines JOIN shared USING (host, norm) WHERE n > 0 GROUP BY rid
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines, CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
  FROM docs JOIN tokens USING (rid) LEFT JOIN repeats USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN lost USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, removed_lines, removed_words,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.5 * n_words AS kept
FROM counted
"""

#: Exact containment of every item in every document (the candidate search must lose none).
OP6_DECONTAMINATION = r"""
WITH side AS (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS rid, text FROM documents
  UNION ALL SELECT 'i', item_id, -row_number() OVER (), text FROM benchmark
), tokens AS (
  SELECT kind, id, rid, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM side
), lengths AS (
  SELECT DISTINCT least(len(w), 5) AS n FROM tokens WHERE kind = 'i' AND len(w) > 0
), shingles AS (
  SELECT DISTINCT kind, id, rid, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM tokens, lengths WHERE len(w) >= n AND (kind = 'd' OR n = least(len(w), 5)))
), items AS (
  SELECT id AS item_id, rid AS irid, g, count(*) OVER (PARTITION BY rid) AS n_shingles FROM shingles WHERE kind = 'i'
), hits AS (
  SELECT d.id AS doc_id, d.rid, item_id, irid, any_value(n_shingles) AS n_shingles, count(*) AS n_shared
  FROM shingles d JOIN items USING (g) WHERE kind = 'd' GROUP BY ALL
)
SELECT doc_id, item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(n_shared AS BIGINT) AS n_shared, n_shared / n_shingles AS containment
FROM hits WHERE n_shared >= 0.8 * n_shingles
"""

#: Hash trees per language and over the languages; CRC-32 by its table (DuckDB has no such function).
OP13_MERKLE = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
), marked AS (
  SELECT *, row_number() OVER () AS rid,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INT)])), 4294967295) % 3 = 0 AS hit
  FROM documents, crc
), hashed AS (
  SELECT rid, doc_id, lang, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(front || coalesce(strlen(text) || ':' || CASE WHEN coalesce(hit, true) THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS now
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS front FROM marked)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM hashed
), nodes AS (
  SELECT g, 0 AS level, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT g, level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY g, level, idx // 8
), subroots AS (
  SELECT g, h, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, g AS idx, n, h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY level, idx // 8
), climb AS (
  SELECT rid, g, 0 AS level, idx, n, now AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT rid, c.g, c.level + 1, c.idx // 8, (c.n + 7) // 8, sha256(string_agg(CASE WHEN k.idx = c.idx THEN c.h ELSE k.h END, '' ORDER BY k.idx)),
         proof || coalesce(string_agg(k.h, '' ORDER BY k.idx) FILTER (k.idx <> c.idx), '')
  FROM climb c JOIN nodes k ON k.g = c.g AND k.level = c.level AND k.idx // 8 = c.idx // 8 WHERE c.n > 1 GROUP BY rid, c.g, c.level, c.idx, c.n, c.h, proof
), above AS (
  SELECT rid, 0 AS level, c.g AS idx, s.n, c.h, proof FROM climb c JOIN subroots s USING (g) WHERE c.n = 1
  UNION ALL
  SELECT rid, c.level + 1, c.idx // 8, (c.n + 7) // 8, sha256(string_agg(CASE WHEN k.idx = c.idx THEN c.h ELSE k.h END, '' ORDER BY k.idx)),
         proof || coalesce(string_agg(k.h, '' ORDER BY k.idx) FILTER (k.idx <> c.idx), '')
  FROM above c JOIN upper k ON k.level = c.level AND k.idx // 8 = c.idx // 8 WHERE c.n > 1 GROUP BY rid, c.level, c.idx, c.n, c.h, proof
)
SELECT doc_id, leaf, s.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256, a.h AS folded_root, a.h = u.h AS verified
FROM leaves l JOIN above a USING (rid) JOIN subroots s USING (g) CROSS JOIN upper u WHERE a.n = 1 AND u.n = 1
"""
