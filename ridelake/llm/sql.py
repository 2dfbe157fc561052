"""The same queries as DuckDB SQL, where SQL can express them on whole tables."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {
    "op1_line_dedup": rf"""
WITH split AS (
  SELECT doc_id, text, coalesce('=' || source, '') AS site, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, site, place, line, regexp_replace(line, '^{_SPACE}|{_SPACE}$', '', 'g') AS trimmed
  FROM (SELECT doc_id, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split)),
boilerplate AS (
  SELECT trimmed FROM lines WHERE regexp_matches(trimmed, '[\p{{L}}\p{{N}}]')
  GROUP BY trimmed HAVING count(DISTINCT site) >= 10),
shares AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_boilerplate,
         bool_or(NOT hit AND regexp_matches(line, '[\p{{L}}\p{{N}}]')) AS cut,
         string_agg(line, chr(10) ORDER BY place) FILTER (NOT hit) AS kept
  FROM (SELECT *, trimmed IN (SELECT trimmed FROM boilerplate) AS hit FROM lines) GROUP BY doc_id)
SELECT doc_id, CASE WHEN cut AND n_boilerplate > 0 THEN coalesce(kept, '') ELSE text END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_boilerplate, 0) AS n_boilerplate,
       CASE WHEN cut AND n_boilerplate > 0 THEN n_boilerplate ELSE 0 END AS n_removed
FROM split LEFT JOIN shares USING (doc_id)""",
    "op5_exact_dedup": f"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS body FROM documents),
entries AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY body)
SELECT doc_id, keep_id, group_size,
       doc_id IS NOT DISTINCT FROM keep_id AND row_number() OVER (PARTITION BY body, doc_id) = 1 AS kept,
       sha256(body) AS text_sha256, 1 AS chain
FROM rows JOIN entries USING (body)""",
    "op10_mixing": f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         md5('mix-1:' || doc_id::VARCHAR) AS queue
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sizes GROUP BY source),
weighted AS (
  SELECT *, [3.0, 1.0, 2.0][rank % 3 + 1]::DOUBLE AS weight, [0.5, 0.0, -0.5][rank % 3 + 1]::DOUBLE AS slope,
         source_size * 2 AS most FROM totals),
-- Sources are full in the order of most / weight; the first level that fills no further source holds.
levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM weighted)::DOUBLE
             - coalesce(sum(most) OVER before, 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
            AS level
  FROM weighted
  WINDOW before AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (
  SELECT level FROM levels WHERE most > level * weight ORDER BY most / weight, rank LIMIT 1),
targets AS (
  SELECT source, source_size, slope,
         CASE WHEN level IS NULL OR most <= level * weight THEN most::DOUBLE ELSE level * weight END AS target
  FROM weighted LEFT JOIN chosen ON true),
queued AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY queue, doc_id, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS first_start
  FROM sizes),
passes AS (
  SELECT doc_id, size, source_size, target, slope, first_start, first_start + source_size AS next_start,
         greatest(0, least(round(target)::BIGINT - first_start, size)) AS first_words,
         greatest(0, least(round(target)::BIGINT - first_start - source_size, size)) AS next_words
  FROM queued JOIN targets ON queued.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, first_words + next_words AS taken,
       CASE WHEN first_words > 0 THEN CASE WHEN slope = 0 THEN first_start / target ELSE
         ((1 + slope) - sqrt((1 + slope) * (1 + slope) - 4 * slope * (first_start / target))) / (2 * slope) + 0.0::DOUBLE
       END END AS "position",
       CASE WHEN next_words > 0 THEN CASE WHEN slope = 0 THEN next_start / target ELSE
         ((1 + slope) - sqrt((1 + slope) * (1 + slope) - 4 * slope * (next_start / target))) / (2 * slope) + 0.0::DOUBLE
       END END AS second_position
FROM passes""",
    "op11_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
words AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words FROM texts),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic,
         (len(words) < 50)::INT
         + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
         + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body))::INT
         + 8 * regexp_matches(body, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > first_id, false)::INT AS mask
  FROM words LEFT JOIN marks USING (doc_id)),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step])::INT - bits[step] AS earlier
  FROM orders, range(1, 6) r(step)),
audit AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (mask & (own | earlier) = 0) AS kept,
         sum(n) FILTER (mask & own > 0 AND mask & earlier = 0) AS removed,
         sum(n) FILTER (mask & own > 0 AND mask & earlier > 0) AS redundant,
         sum(n) FILTER (mask = own) AS unique_fails,
         sum(good) FILTER (mask & own > 0 AND mask & earlier = 0) AS good_lost,
         sum(toxic) FILTER (mask & own > 0 AND mask & earlier = 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM audit""",
    "op12_importance_resampling": r"""
WITH RECURSIVE crc_steps AS (
  SELECT i AS entry, i::BIGINT AS v, 0 AS step FROM range(256) r(i)
  UNION ALL
  SELECT entry, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM crc_steps WHERE step < 8),
crc AS (SELECT list(v ORDER BY entry) AS steps FROM crc_steps WHERE step = 8),
said AS (
  SELECT 'd' AS side, row_number() OVER () AS place, doc_id, text FROM documents
  UNION ALL SELECT 't', 0, NULL, text FROM benchmark),
split AS (
  SELECT side, place, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM said),
used AS (
  SELECT side, place, word, count(*) AS n FROM (SELECT side, place, unnest(words) AS word FROM split) GROUP BY ALL),
coded AS (SELECT word, hex(encode(word)) AS code FROM (SELECT DISTINCT word FROM used)),
bucketed AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [('0x' || substr(code, 2 * i + 1, 2))::BIGINT FOR i IN range(length(code) // 2)]),
    lambda a, b: xor(a >> 8, steps[xor(a & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM coded, crc),
hits AS (SELECT side, place, bucket, n FROM used JOIN bucketed USING (word)),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 't'), 0)::DOUBLE AS t
  FROM hits GROUP BY bucket),
every AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM totals),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
  FROM totals, every),
weights AS (
  SELECT place, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM hits JOIN gains USING (bucket) WHERE side = 'd' GROUP BY place),
scored AS (
  SELECT place, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (place) WHERE side = 'd'),
able AS (
  SELECT place, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, place) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT * FROM able WHERE rank <= 10 * (SELECT count(*) FROM able) // 100) USING (place)""",
}
