"""Registered queries: access tiers, snapshots, history, stats, scalar
functions, claims, memoised enrichment and batching windows."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.text import csv_field, strip_bom, strip_ws, tokens
from strata.operators.chunks import with_tier
from strata.operators.windows import count_batches, global_row_number
from strata.plans.registry import Ctx, register
from strata.plans.sqlgen import STRIP, WS, clearance_values, community_ctes, graph_ctes, ntok, report_ctes, \
    tier_sql, with_ctes

G = graph_ctes()
GR = G + community_ctes() + report_ctes()


def clearance_df(spark):
    return spark.createDataFrame([(u, t) for u, ts in C.CLEARANCE.items() for t in ts], "user_level string, level string")


# ---------------------------------------------------------------- access tiers

@register("clearance_join", f"""
SELECT c.user_level, d.level, count(*) AS n_docs
FROM (SELECT {tier_sql()} AS level FROM documents) d JOIN {clearance_values('c')} ON d.level = c.level
GROUP BY c.user_level, d.level""")
def clearance_join(spark, d):
    """Rows a user may read: the 6-row clearance table is fixed -> broadcast."""
    docs = with_tier(Ctx(spark, d).t.documents).select("level")
    return (docs.join(F.broadcast(clearance_df(spark)), "level")
            .groupBy("user_level", "level").agg(F.count(F.lit(1)).alias("n_docs")))


@register("unknown_clearance", f"""
SELECT c.user_level, count(*) AS n_docs
FROM (SELECT {tier_sql()} AS level FROM documents) d
JOIN (SELECT * FROM {clearance_values('c0')} WHERE user_level = 'contractor') c ON d.level = c.level
GROUP BY c.user_level""")
def unknown_clearance(spark, d):
    """An unknown clearance sees zero rows (instead of failing)."""
    docs = with_tier(Ctx(spark, d).t.documents).select("level")
    cl = clearance_df(spark).where(F.col("user_level") == "contractor")
    return docs.join(F.broadcast(cl), "level").groupBy("user_level").agg(F.count(F.lit(1)).alias("n_docs"))


@register("tier_union", with_ctes(GR + [f"cl AS (SELECT * FROM {clearance_values('c')})"], """
SELECT cl.user_level, r.level, count(*) AS n_reports FROM reports r JOIN cl ON r.level = cl.level
GROUP BY cl.user_level, r.level"""))
def tier_union(spark, d):
    """Union of the tier indexes a user may read (one table with a level column)."""
    ctx = Ctx(spark, d)
    parts = None
    for user, tiers in C.CLEARANCE.items():  # fixed three users
        u = ctx.reports.where(F.col("level").isin(*tiers)).select(F.lit(user).alias("user_level"), "level")
        parts = u if parts is None else parts.unionByName(u)
    return parts.groupBy("user_level", "level").agg(F.count(F.lit(1)).alias("n_reports"))


# ---------------------------------------------------------------- snapshots

SNAP_SQL = """snaps AS (
  SELECT event_type AS idx, strftime(ts, '%Y%m%d-%H%M%S') AS folder FROM events
  UNION ALL SELECT event_type, 'notes_' || event_type FROM events)"""


def _snapshots(ctx):
    e = ctx.t.events
    s = e.select(F.col("event_type").alias("idx"), F.date_format("ts", "yyyyMMdd-HHmmss").alias("folder"))
    n = e.select(F.col("event_type").alias("idx"), F.concat(F.lit("notes_"), "event_type").alias("folder"))
    return s.unionByName(n)


@register("latest_snapshot", f"""
WITH {SNAP_SQL}
SELECT idx, arg_max(folder, (CAST(split_part(folder, '-', 1) AS BIGINT), CAST(split_part(folder, '-', 2) AS BIGINT), folder))
  AS folder FROM snaps WHERE folder LIKE '%-%' GROUP BY idx""")
def latest_snapshot(spark, d):
    """Per index: the folder with the largest (date, time) among names
    containing '-' (a combinable max over a struct, no window)."""
    s = _snapshots(Ctx(spark, d)).where(F.col("folder").contains("-"))
    p = F.split("folder", "-")
    key = F.struct(p[0].cast("long").alias("a"), p[1].cast("long").alias("b"), F.col("folder").alias("f"))
    return s.groupBy("idx").agg(F.max(key).alias("k")).select("idx", F.col("k.f").alias("folder"))


@register("snapshot_sort", f"""
WITH {SNAP_SQL}
SELECT idx, folder, row_number() OVER (ORDER BY idx, CAST(split_part(folder, '-', 1) AS BIGINT),
       CAST(split_part(folder, '-', 2) AS BIGINT), folder) AS row_id FROM snaps WHERE folder LIKE '%-%'""")
def snapshot_sort(spark, d):
    s = _snapshots(Ctx(spark, d)).where(F.col("folder").contains("-"))
    p = F.split("folder", "-")
    s = s.withColumn("a", p[0].cast("long")).withColumn("b", p[1].cast("long"))
    return global_row_number(s, [F.col("idx"), F.col("a"), F.col("b"), F.col("folder")]).drop("a", "b")


# ---------------------------------------------------------------- conversation history

@register("history_window", f"""
SELECT conv_id, turn, CAST(rn AS INTEGER) AS rn FROM (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
  FROM conversations WHERE role = 'user') WHERE rn <= {C.HISTORY_TURNS}""")
def history_window(spark, d):
    c = Ctx(spark, d).t.conversations.where(F.col("role") == "user")
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    return (c.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= C.HISTORY_TURNS)
            .select("conv_id", "turn", F.col("rn").cast("int")))


@register("history_budget", f"""
SELECT conv_id, turn, CAST(cum_tokens AS BIGINT) AS cum_tokens FROM (
  SELECT conv_id, turn, sum({ntok('text')}) OVER (PARTITION BY conv_id ORDER BY turn
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tokens,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
  FROM conversations) WHERE cum_tokens <= {C.ANSWER_BUDGET}""")
def history_budget(spark, d):
    """Conversation turns kept while the running token sum fits the answer budget."""
    from strata.operators.windows import budget_prefix
    c = Ctx(spark, d).t.conversations.withColumn("tokens", F.size(tokens(F.col("text"))))
    r = budget_prefix(c, ["conv_id"], [F.col("turn")], "tokens", C.ANSWER_BUDGET)
    return r.select("conv_id", "turn", F.col("cum_tokens").cast("long"))


# ---------------------------------------------------------------- run statistics

STATS_SQL = """stats AS (SELECT event_type AS workflow, 'k' || json_extract_string(props, '$.k') AS verb,
                  value AS seconds FROM events)"""


def _stats(ctx):
    e = ctx.t.events
    return e.select(F.col("event_type").alias("workflow"),
                    F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("verb"),
                    F.col("value").alias("seconds"))


@register("stats_rollup", f"""
WITH {STATS_SQL}
SELECT workflow, verb, round(sum(seconds), 6) AS seconds, count(*) AS n FROM stats GROUP BY ROLLUP (workflow, verb)""")
def stats_rollup(spark, d):
    s = _stats(Ctx(spark, d))
    return s.rollup("workflow", "verb").agg(F.round(F.sum("seconds"), 6).alias("seconds"),
                                           F.count(F.lit(1)).alias("n"))


@register("run_stats_report", f"""
WITH {STATS_SQL}
SELECT workflow, round(s, 6) AS seconds, round(s / sum(s) OVER (), 6) AS share FROM (
  SELECT workflow, sum(seconds) AS s FROM stats GROUP BY workflow)""")
def run_stats_report(spark, d):
    """Seconds per workflow and share of the total; the total is taken over
    the aggregated rows (one per workflow), never over raw rows."""
    per = _stats(Ctx(spark, d)).groupBy("workflow").agg(F.sum("seconds").alias("s"))
    over_all = Window.partitionBy()  # spans the aggregate only: one row per workflow
    return per.select("workflow", F.round("s", 6).alias("seconds"),
                      F.round(F.col("s") / F.sum("s").over(over_all), 6).alias("share"))


@register("map_ops", """
SELECT event_type, key, CAST(sum(val) AS BIGINT) AS total, count(*) AS n FROM (
  SELECT event_type, unnest(map_keys(m)) AS key, unnest(map_values(m)) AS val FROM (
    SELECT event_type, CAST(json(props) AS MAP(VARCHAR, BIGINT)) AS m FROM events))
GROUP BY event_type, key""")
def map_ops(spark, d):
    """JSON object -> MAP -> explode -> per-key totals."""
    e = Ctx(spark, d).t.events
    m = e.select("event_type", F.from_json("props", "map<string,bigint>").alias("m"))
    return (m.select("event_type", F.explode("m").alias("key", "val"))
            .groupBy("event_type", "key").agg(F.sum("val").alias("total"), F.count(F.lit(1)).alias("n")))


@register("array_ops", f"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, CAST(len(list_distinct(w)) AS INTEGER) AS n_distinct,
       CAST(CASE WHEN len(w) = 0 THEN 0 ELSE len(range(0, len(w), {C.WORD_STRIDE})) END AS INTEGER) AS n_windows,
       array_to_string(w[1:3], ' ') AS first3
FROM (SELECT doc_id, regexp_extract_all(text, {WS}) AS w FROM documents)""")
def array_ops(spark, d):
    docs = Ctx(spark, d).t.documents.select("doc_id", tokens(F.col("text")).alias("w"))
    n = F.size("w")
    nwin = F.when(n == 0, 0).otherwise(F.size(F.sequence(F.lit(0), n - 1, F.lit(C.WORD_STRIDE))))
    return docs.select("doc_id", n.alias("n_words"), F.size(F.array_distinct("w")).alias("n_distinct"),
                       nwin.cast("int").alias("n_windows"), F.array_join(F.slice("w", 1, 3), " ").alias("first3"))


# ---------------------------------------------------------------- scalar functions

@register("str_clean", f"""
SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '^﻿', ''), {STRIP}, '', 'g'),
                                  '[ \t\n\r\f]+', ' ', 'g')) AS clean_hash,
       upper(regexp_replace(split_part(regexp_replace(regexp_replace(text, '^﻿', ''), {STRIP}, '', 'g'), ' ', 1),
                            '[^A-Za-z]', '', 'g')) AS first_word
FROM documents""")
def str_clean(spark, d):
    t = Ctx(spark, d).t.documents
    s = strip_ws(strip_bom(F.col("text")))
    clean = F.regexp_replace(s, "[ \t\n\r\f]+", " ")
    # upper-casing restricted to ASCII letters: Unicode case maps differ between engines
    first = F.regexp_replace(F.split(s, " ")[0], "[^A-Za-z]", "")
    return t.select("doc_id", F.md5(clean).alias("clean_hash"), F.upper(first).alias("first_word"))


@register("csv_line", with_ctes(G, """
SELECT e.level, e.title, '"' || replace(e.title, '"', '""') || '","' || replace(e.type, '"', '""') || '","'
       || replace(e.description, '"', '""') || '",' || CAST(d.degree AS VARCHAR) AS line
FROM entities e JOIN degrees d ON e.level = d.level AND e.title = d.title"""))
def csv_line(spark, d):
    g = Ctx(spark, d).g
    e = g.entities.join(g.degrees, ["level", "title"])
    return e.select("level", "title", F.concat_ws(",", csv_field(F.col("title")), csv_field(F.col("type")),
                                                  csv_field(F.col("description")),
                                                  F.col("degree").cast("string")).alias("line"))


@register("json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_extract(spark, d):
    e = Ctx(spark, d).t.events
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


# ---------------------------------------------------------------- claims

CLAIM_DELIM = C.TUPLE_DELIM


def claim_strings(pair_rows):
    """Claim records built from extracted relationships: subject, object,
    type, status, start, end (NONE), description, source text."""
    status = F.when(F.col("strength") >= 2, "TRUE").when(F.col("strength") == 1, "SUSPECTED").otherwise("FALSE")
    return pair_rows.select("level", "unit_id", F.concat_ws(
        CLAIM_DELIM, "source", "target", F.lit("RELATED"), status, F.lit("NONE"), F.lit("NONE"),
        F.regexp_replace("description", "<\\|>", " "), "unit_id").alias("claim"))


def parse_claims(claims):
    f = F.split("claim", "<\\|>")
    none = lambda c: F.when(c == "NONE", F.lit(None)).otherwise(c)
    status = F.upper(F.get(f, 3))
    g = lambda i: F.get(f, i)  # noqa: E731  - NULL instead of an error on short records
    return claims.select(
        "level", g(0).alias("subject"), none(g(1)).alias("object"), g(2).alias("type"), status.alias("status"),
        F.try_to_timestamp(none(g(4))).alias("start_ts"), F.try_to_timestamp(none(g(5))).alias("end_ts"),
        g(6).alias("description"), g(7).alias("source_text"),
        ((F.size(f) == 8) & status.isin(*C.CLAIM_STATUS)).alias("valid"))


CLAIMS_SQL = """claims AS (SELECT level, source AS subject, target AS object, 'RELATED' AS type,
  CASE WHEN strength >= 2 THEN 'TRUE' WHEN strength = 1 THEN 'SUSPECTED' ELSE 'FALSE' END AS status,
  description, unit_id FROM pair_rows)"""


@register("parse_claim_records", with_ctes(G + [CLAIMS_SQL], """
SELECT subject, object, type, status, unit_id AS source_text, true AS valid FROM claims"""))
def parse_claim_records(spark, d):
    p = parse_claims(claim_strings(Ctx(spark, d).g.pair_rows))
    return p.select("subject", "object", "type", "status", "source_text", "valid")


@register("claims_for_entities", with_ctes(G + [CLAIMS_SQL], """
SELECT e.level, e.title, count(*) AS n_claims, count(*) FILTER (WHERE c.status = 'TRUE') AS n_true
FROM claims c JOIN entities e ON c.level = e.level AND upper(c.subject) = e.title GROUP BY e.level, e.title"""))
def claims_for_entities(spark, d):
    ctx = Ctx(spark, d)
    p = parse_claims(claim_strings(ctx.g.pair_rows)).where("valid").select(
        "level", F.upper("subject").alias("title"), "status")
    j = p.join(ctx.g.entity_stats.select("level", "title"), ["level", "title"])
    return j.groupBy("level", "title").agg(F.count(F.lit(1)).alias("n_claims"),
                                           F.count(F.when(F.col("status") == "TRUE", 1)).alias("n_true"))


@register("claim_dates", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_ts, CAST(year(ts) AS INTEGER) AS start_year,
       value < 10 AS end_missing FROM events""")
def claim_dates(spark, d):
    """ISO-8601 start dates and NONE end dates from claim strings built on
    the events table (one claim per event)."""
    e = Ctx(spark, d).t.events
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    end = F.when(F.col("value") < 10, F.lit("NONE")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    c = e.select("event_id", F.concat_ws(CLAIM_DELIM, iso, end).alias("c"))
    f = F.split("c", "<\\|>")
    none = lambda x: F.when(x == "NONE", F.lit(None)).otherwise(x)
    st = F.to_timestamp_ntz(none(f[0]), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    en = F.to_timestamp_ntz(none(f[1]), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return c.select("event_id", F.date_format(st, "yyyy-MM-dd HH:mm:ss").alias("start_ts"),
                    F.year(st).alias("start_year"), en.isNull().alias("end_missing"))


# ---------------------------------------------------------------- memoised enrichment

def _expensive(batches):
    """Stand-in for a model call: whitespace token count, per Arrow batch."""
    rx = re.compile(C.WS_TOKEN_RE)
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"],
                            "result": ["computed:" + str(len(rx.findall(t or ""))) for t in pdf["text"]]})


def memoized(docs, cache):
    """Only inputs whose (text, params) hash is not cached reach the
    expensive step; cached results are reused; union of both."""
    params = "model=rule;temperature=0"
    k = docs.select("doc_id", "text", F.sha2(F.concat_ws("|", "text", F.lit(params)), 256).alias("key"))
    miss = k.join(cache.select("key"), "key", "left_anti")
    fresh = miss.select("doc_id", "text").mapInPandas(_expensive, "doc_id long, result string") \
        .withColumn("from_cache", F.lit(False))
    hit = k.join(cache, "key").select("doc_id", "result", F.lit(True).alias("from_cache"))
    return fresh.unionByName(hit)


def label_cache(ctx):
    params = "model=rule;temperature=0"
    docs = ctx.t.documents.select("doc_id", "text")
    return (ctx.t.labels.join(docs, "doc_id")
            .select(F.sha2(F.concat_ws("|", "text", F.lit(params)), 256).alias("key"),
                    F.concat(F.lit("cached:"), F.col("quality").cast("string")).alias("result"))
            .groupBy("key").agg(F.min("result").alias("result")))


@register("memoized_enrichment", f"""
WITH k AS (SELECT doc_id, text, sha256(text || '|model=rule;temperature=0') AS key FROM documents),
cache AS (SELECT sha256(d.text || '|model=rule;temperature=0') AS key, min('cached:' || CAST(l.quality AS VARCHAR)) AS result
          FROM labels l JOIN documents d USING (doc_id) GROUP BY 1)
SELECT k.doc_id, coalesce(c.result, 'computed:' || CAST({ntok('k.text')} AS VARCHAR)) AS result,
       c.result IS NOT NULL AS from_cache
FROM k LEFT JOIN cache c USING (key)""")
def memoized_enrichment(spark, d):
    ctx = Ctx(spark, d)
    return memoized(ctx.t.documents, label_cache(ctx))


# ---------------------------------------------------------------- batching windows

@register("batch_ids_by_count", with_ctes(G, f"""
SELECT level, id, CAST(floor((row_number() OVER (PARTITION BY level ORDER BY id) - 1)
       / {C.EMBED_BATCH_SIZE}) AS INTEGER) AS batch FROM entities"""))
def batch_ids_by_count(spark, d):
    e = Ctx(spark, d).g.entity_stats.select("level", "id")
    return count_batches(e, "id", part=("level",)).select("level", "id", "batch")


@register("report_row_id", with_ctes(GR, """
SELECT community, rating, row_number() OVER (ORDER BY rating DESC, community) AS row_id FROM reports"""))
def report_row_id(spark, d):
    r = Ctx(spark, d).reports.select("community", "rating")
    return global_row_number(r, [F.col("rating").desc(), F.col("community")])
