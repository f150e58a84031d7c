"""Query and SQL of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import quality
from strata.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality.judge(docs, drop=("text",)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_bad")


# The SQL counts words by position (regular expression, unnest, windows over
# positions) and restates the moment fit of the beta prior.
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
OP1_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, t, regexp_extract_all(t, '{_WORD}') AS words FROM d
), pos AS (
  SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), tri AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS c FROM pos
), rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE c > 1) GROUP BY rid
), ln AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY rid
), f AS (
  SELECT d.rid, d.doc_id, d.source, len(w.words) AS n_words,
         length(regexp_replace(d.t, '{_SPACE}', '', 'g')) AS word_chars,
         length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(ln.n_lines, 0) AS n_lines, coalesce(ln.n_dup_lines, 0) AS n_dup_lines,
         coalesce(rep.n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN ln USING (rid) LEFT JOIN rep USING (rid)
), r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS r1,
         10 * n_symbols > n_words AS r2, 100 * n_dup_lines > 30 * n_lines AS r3,
         word_chars < 3 * n_words OR word_chars > 10 * n_words AS r4
  FROM f
), h AS (
  SELECT source, k, count(*) AS n, sum(CASE WHEN x THEN 1 ELSE 0 END) AS c
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS k, unnest([r1, r2, r3, r4]) AS x FROM r WHERE source IS NOT NULL)
  GROUP BY source, k
), g AS (
  SELECT k, sum(n) AS n, count(*) AS hosts, sum(c) / sum(n) AS m, sum(c * c / n) / sum(n) AS sq FROM h GROUP BY k
), p AS (
  SELECT k, m, CASE WHEN m * (1 - m) <= 0 OR sq - m * m - m * (1 - m) * hosts / n <= m * (1 - m) / n THEN n
    ELSE greatest(1, least(n, m * (1 - m) / (sq - m * m - m * (1 - m) * hosts / n) - 1)) END AS s FROM g
), v AS (
  SELECT h.source, bool_or(k = 1 AND bad) AS b1, bool_or(k = 2 AND bad) AS b2,
         bool_or(k = 3 AND bad) AS b3, bool_or(k = 4 AND bad) AS b4
  FROM (SELECT h.source, h.k, (h.c + p.m * p.s) / (h.n + p.s) > 0.5 AS bad FROM h JOIN p USING (k)) h
  GROUP BY h.source
), o AS (
  SELECT r.*, coalesce((r2 AND (b2 OR b1)) OR (r3 AND (b3 OR b1)) OR (r4 AND (b4 OR b1)), false) AS host_bad
  FROM r LEFT JOIN v ON r.source = v.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 AS base_failed,
       NOT r1 AND NOT host_bad AS kept, host_bad
FROM o
"""
QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES = {"op1_quality_rules": OP1_SQL}
