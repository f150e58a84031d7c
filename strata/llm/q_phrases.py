"""Query and SQL of phrase collocations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import phrases
from strata.llm.common import table


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


# The SQL counts each length of phrase by itself, from lists of the words of a piece.
OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents
), ones AS (
  SELECT lang, unnest(w) AS x, count(*) AS f FROM pieces GROUP BY lang, x
), twos AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM pieces) GROUP BY ALL HAVING count(*) >= 10
), threes AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM pieces) GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(f)::HUGEINT AS n FROM ones GROUP BY lang
), cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, 1 AS k, p.f AS l, q.f AS r
  FROM twos t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN ones q ON q.lang = t.lang AND q.x = t.y
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, p.f, q.f
  FROM threes t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN twos q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, p.f, q.f
  FROM threes t JOIN twos p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN ones q ON q.lang = t.lang AND q.x = t.z
), scored AS (
  SELECT *, 1000000::HUGEINT * a * a // (l::HUGEINT * r) AS score FROM cuts
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, x || ' ' || y AS phrase, f FROM threes UNION ALL SELECT lang, y || ' ' || z, f FROM threes) GROUP BY lang, phrase
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longer g USING (lang, phrase) WHERE g.f IS NULL OR 100 * g.f < 50 * b.a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
"""
QUERIES = {"op11_phrase_collocations": op11_phrase_collocations}
ORACLES = {"op11_phrase_collocations": OP11_SQL}
