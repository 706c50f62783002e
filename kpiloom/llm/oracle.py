"""DuckDB SQL for the queries that SQL can express."""

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), win AS (
  SELECT k, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT k, count(*) AS n_repeat_words FROM (SELECT DISTINCT k, i + j AS at FROM twice, (VALUES (0), (1), (2)) o(j)) GROUP BY k
), lines AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT s) AS n_dup_lines
  FROM (SELECT k, unnest(string_split(t, chr(10))) AS s FROM d) WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY k
), m AS (
  SELECT k, doc_id, lang, source, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (k) LEFT JOIN lines USING (k)
), rated AS (
  SELECT *, n_words < 50 OR 2 * n_repeat_words > n_words AS base_failed,
         1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS same_lines,
         1000 * n_repeat_words // greatest(n_words, 1) AS repeats,
         floor(100 * ln(word_chars::DOUBLE / nullif(n_words, 0)))::BIGINT AS len_step
  FROM m
), long AS (
  SELECT lang, source, measure, v FROM rated UNPIVOT (v FOR measure IN (symbols, same_lines, repeats, len_step))
  WHERE NOT base_failed AND (measure = 'len_step' OR v > 0)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, measure ORDER BY v) AS r,
         count(*) OVER (PARTITION BY lang, source, measure) AS n
  FROM long
), lim AS (
  SELECT lang, source, measure, any_value(n) AS n, min(v) FILTER (r >= n / 4.0) AS q1, min(v) FILTER (r >= 3 * n / 4.0) AS q3,
         min(v) FILTER (20 * r >= 19 * n) AS top
  FROM ranked GROUP BY ALL
), held AS (
  SELECT k, x.measure, CASE WHEN x.measure = 'len_step' THEN v BETWEEN q1 - 3 * greatest(q3 - q1, 1) AND q3 + 3 * greatest(q3 - q1, 1)
                          ELSE v = 0 OR coalesce(n > 1 AND (v <= top OR v * q1 ** 3 <= q3 ** 4), false) END AS usual
  FROM (SELECT k, lang, source, measure, v FROM rated UNPIVOT (v FOR measure IN (symbols, same_lines, repeats, len_step))
        WHERE NOT base_failed) x
  LEFT JOIN lim y ON x.lang IS NOT DISTINCT FROM y.lang AND x.source IS NOT DISTINCT FROM y.source AND x.measure = y.measure
), fine AS (SELECT k FROM held GROUP BY k HAVING bool_and(usual))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       k IN (SELECT k FROM fine) AS kept
FROM rated
"""

NEGATIVES = """
WITH r AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.k, a.vec_id AS anchor_id, a.label = b.label AS same, b.k AS other, b.vec_id AS other_id,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.k <> b.k WHERE a.vec_id % 100 = 0
), pos AS (
  SELECT k, anchor_id, other, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, other_id) <= 5
)
SELECT pos.anchor_id, positive_id, row_number() OVER of_positive::INT AS rank, s.other_id AS negative_id,
       positive_score, s.score AS negative_score
FROM pos JOIN s ON s.k = pos.k AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW of_positive AS (PARTITION BY pos.k, pos.other ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER of_positive <= 10
"""

ORACLE: dict[str, str] = {"op8_quality_rules": QUALITY, "op11_hard_negatives": NEGATIVES}
