"""Query and SQL of benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate
from strata.llm.common import table


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_near=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated", "n_near", "near_words")


# The SQL hashes no index: it compares every window of the documents with every window of the items,
# and takes for each place of an item's terms the last place of each up to there.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP8_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents
), i AS (
  SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), iw AS (
  SELECT DISTINCT item_id, n, list_slice(w, s, s + n - 1) AS words
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM i)
), sizes AS (
  SELECT DISTINCT n FROM i
), dw AS (
  SELECT rid, n, s, list_slice(w, s, s + n - 1) AS words
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN sizes ON len(w) >= n)
), m AS (
  SELECT dw.rid, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.words = iw.words
), h AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM m) GROUP BY rid
), t AS (
  SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY rid
), ip AS (
  SELECT item_id, unnest(w) AS term, unnest(range(len(w))) AS i FROM i
), dp AS (
  SELECT rid, unnest(w) AS term, unnest(range(len(w))) AS p FROM d
), c AS (
  SELECT term, count(*) AS n FROM dp GROUP BY term
), a AS (
  SELECT item_id, term, i FROM ip JOIN c USING (term)
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY n, term, i) = 1
), b AS (
  SELECT DISTINCT a.item_id, ip.term, c.n FROM a JOIN ip ON ip.item_id = a.item_id AND abs(ip.i - a.i) < 13
  JOIN c ON c.term = ip.term WHERE ip.term <> a.term
), s AS (
  SELECT item_id, term, 0 AS slot FROM a
  UNION ALL SELECT item_id, term, row_number() OVER (PARTITION BY item_id ORDER BY n, term) AS slot FROM b
), k AS (
  SELECT item_id, slot // 3 AS part, term, slot % 3 AS slot, count(*) OVER (PARTITION BY item_id, slot // 3) AS n_terms
  FROM s WHERE slot < 6
), l AS (
  SELECT rid, item_id, n_terms, p, max(CASE WHEN slot = 0 THEN p END) OVER u AS p0,
         max(CASE WHEN slot = 1 THEN p END) OVER u AS p1, max(CASE WHEN slot = 2 THEN p END) OVER u AS p2
  FROM dp JOIN k USING (term) WINDOW u AS (PARTITION BY rid, item_id, part ORDER BY p)
), near AS (
  SELECT rid, count(DISTINCT item_id) AS n_near, min(p - least(p0, p1, coalesce(p2, p1)) + 1) AS near_words
  FROM l WHERE n_terms > 1 AND p0 IS NOT NULL AND p1 IS NOT NULL AND (n_terms < 3 OR p2 IS NOT NULL)
    AND p - least(p0, p1, coalesce(p2, p1)) < 20 GROUP BY rid
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated,
       coalesce(near.n_near, 0) AS n_near, near.near_words
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid) LEFT JOIN near USING (rid)
"""
QUERIES = {"op8_decontamination": op8_decontamination}
ORACLES = {"op8_decontamination": OP8_SQL}
