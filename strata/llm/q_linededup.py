"""Query and SQL of line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import linededup
from strata.llm.common import table


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.remove_repeated_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), "text")


# The SQL selects no fingerprints: it compares the text of every run of three lines.
OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents
), u AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), w AS (
  SELECT doc_id, p, line AS a, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c
  FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS k
                         FROM w WHERE c IS NOT NULL) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS p FROM later
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.p IS NULL) AS text,
         count(u.p) AS n_lines, count(g.p) AS n_removed
  FROM l LEFT JOIN u ON u.doc_id = l.doc_id AND u.i = l.i LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.p = u.p
  GROUP BY l.doc_id
)
SELECT doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
QUERIES = {"op2_line_dedup": op2_line_dedup}
ORACLES = {"op2_line_dedup": OP2_SQL}
