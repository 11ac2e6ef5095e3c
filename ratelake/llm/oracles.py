"""DuckDB SQL for the operators that SQL can state; written apart from the Spark code."""

from __future__ import annotations

from ratelake.llm.quality import STOP_WORDS

SPACES = r"[\x20\x09-\x0D]+"
WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{SPACES}'), lambda x: x <> '')"
NO_SPACES = r"regexp_replace({}, '[\x20\x09-\x0D]', '', 'g')"
_STOPS = " ".join(
    f"WHEN lang = '{lang}' THEN len(list_filter(w, lambda x: lower(x) IN ({', '.join(repr(s) for s in words)})))"
    for lang, words in STOP_WORDS.items()
)

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, lang, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: {NO_SPACES.format('x')} <> '') AS l
  FROM documents),
seen AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
windows AS (
  SELECT rid, i, x || ' ' || lead(x, 1) OVER (PARTITION BY rid ORDER BY i) || ' ' || lead(x, 2) OVER (PARTITION BY rid ORDER BY i) AS g
  FROM seen),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows WHERE g IS NOT NULL) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY rid),
m AS (
  SELECT doc_id, len(w) AS n_words, length({NO_SPACES.format('t')}) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         CASE {_STOPS} END AS n_stop_words
  FROM d LEFT JOIN covered USING (rid)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         list_filter([
           CASE WHEN n_words > 0 AND (word_chars / n_words < 2 OR word_chars / n_words > 12) THEN 'word_length' END,
           CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
           CASE WHEN n_words > 0 AND n_stop_words / n_words < 0.03 THEN 'stop_words' END,
           CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'duplicate_lines' END], lambda x: x IS NOT NULL) AS b
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND len(b) = 0 AS kept, array_to_string(b, ',') AS broken
FROM v
"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source),
-- The level at which the sources that are below their bound share what the others leave.
l AS (
  SELECT *, 2.0 * source_size AS bound,
         (1.5 * sum(source_size) OVER ()
          - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (
  SELECT source, source_size,
         CAST(CASE WHEN level * weight < bound
                   THEN least(bound, weight * max(CASE WHEN level * weight < bound THEN level END) OVER ()) ELSE bound END AS DOUBLE) AS target
  FROM l),
r AS (
  SELECT d.doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST(('0x' || substr(md5('mix-1/' || coalesce(d.source, '')), 1, 5)) AS BIGINT) / 1048576.0 AS start,
         row_number() OVER (PARTITION BY d.source ORDER BY length(CAST(size AS VARCHAR)) * 100 + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS INTEGER),
           substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8), d.doc_id NULLS FIRST) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(start + rate * k) - floor(start + rate * (k - 1)) AS BIGINT) AS copies,
       CAST(floor(start + rate * k) - floor(start + rate * (k - 1)) AS BIGINT) * size AS taken
FROM r
"""
