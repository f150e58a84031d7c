"""Query and SQL of importance resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import resample
from strata.llm.common import table


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


# The SQL reads words by a regular expression and computes crc32 from the bytes in hex, by
# a table of 256 remainders made from the polynomial.
_HEX = "'0123456789ABCDEF'"
OP13_SQL = rf"""
WITH tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), texts AS (
  SELECT row_number() OVER () AS rid, 'd' AS side, doc_id, text FROM documents
  UNION ALL SELECT row_number() OVER (), 'b', NULL, text FROM benchmark
), ws AS (
  SELECT rid, side, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
), one AS (
  SELECT rid, side, unnest(words) AS w FROM ws
), hexed AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM one)
), bucket AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i:
      (instr({_HEX}, substr(h, CAST(2 * i + 1 AS BIGINT), 1)) - 1) * 16 + instr({_HEX}, substr(h, CAST(2 * i + 2 AS BIGINT), 1)) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS b
  FROM hexed, tab
), feats AS (
  SELECT o.rid, o.side, k.b, count(*) AS c FROM one o JOIN bucket k USING (w) GROUP BY o.rid, o.side, k.b
), counts AS (
  SELECT b, coalesce(sum(c) FILTER (side = 'd'), 0) AS s, coalesce(sum(c) FILTER (side = 'b'), 0) AS t
  FROM feats GROUP BY b
), totals AS (
  SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counts
), gains AS (
  SELECT b, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE)
                                 / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM counts, totals
), weighed AS (
  SELECT f.rid, CAST(floor(sum(f.c * g.g)::DOUBLE / sum(f.c)::DOUBLE) AS BIGINT) AS weight
  FROM feats f JOIN gains g USING (b) WHERE f.side = 'd' GROUP BY f.rid
), scored AS (
  SELECT ws.rid, ws.doc_id, CAST(len(ws.words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i:
      CAST(instr('0123456789abcdef', substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), CAST(i + 1 AS BIGINT), 1)) - 1 AS BIGINT))),
      lambda x, d: x * 16 + d) + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score
  FROM ws LEFT JOIN weighed USING (rid) WHERE ws.side = 'd'
), ranked AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
    PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) END AS r,
    10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS drawn FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= drawn THEN r END AS rank FROM ranked
"""
QUERIES = {"op13_importance_resampling": op13_importance_resampling}
ORACLES = {"op13_importance_resampling": OP13_SQL}
