"""Registered queries: community reports, global and local search, tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import config as C
from strata.operators import reports as R
from strata.operators import search as S
from strata.operators.windows import global_row_number, greedy_pack
from strata.plans.registry import Ctx, register
from strata.plans.sqlgen import (clearance_values, community_ctes, entity_match_ctes, graph_ctes, local_ctes, ntok,
                                 report_ctes, search_ctes, with_ctes)

GC = graph_ctes() + community_ctes()
GR = GC + report_ctes()
GS = GR + search_ctes()
GL = GR + entity_match_ctes() + local_ctes()


def clearance_df(spark):
    rows = [(u, t) for u, ts in C.CLEARANCE.items() for t in ts]
    return spark.createDataFrame(rows, "user_level string, level string")




# ---------------------------------------------------------------- reports

@register("community_reports", with_ctes(GR, """
SELECT level, CAST(cluster_level AS INTEGER) AS cluster_level, community, title, rating, size,
       CAST(n_findings AS INTEGER) AS n_findings, full_content FROM reports"""))
def community_reports(spark, d):
    r = Ctx(spark, d).reports
    return r.select("level", F.col("cluster_level").cast("int"), "community", "title", "rating", "size",
                    F.size("findings").alias("n_findings"), "full_content")


@register("parse_reports_json", with_ctes(GR, """
SELECT community, title, rating, CAST(n_findings AS INTEGER) AS n_findings, rating_explanation,
       rating BETWEEN 0 AND 10 AS valid FROM reports"""))
def parse_reports_json(spark, d):
    """Report JSON -> struct (PERMISSIVE; malformed or out-of-range -> invalid)."""
    r = R.parse_report_json(Ctx(spark, d).reports.select("community", "json"))
    return r.select("community", "title", "rating", F.size("findings").alias("n_findings"), "rating_explanation",
                    "valid")


@register("community_context", with_ctes(GC + [
    """ctx_e AS (SELECT DISTINCT a.level, a.cluster_level, a.community, r.id, r.source, r.target, r.description, r.rank
  FROM ranked_relationships r JOIN assign a ON r.level = a.level AND (r.source = a.title OR r.target = a.title))""",
    """ctx_r AS (SELECT *, len(regexp_extract_all(concat_ws(',',
      '"' || replace(id, '"', '""') || '"', '"' || replace(source, '"', '""') || '"',
      '"' || replace(target, '"', '""') || '"', '"' || replace(description, '"', '""') || '"',
      CAST(rank AS VARCHAR)), '[^ \t\n\r\f]+')) AS tokens FROM ctx_e)"""], f"""
SELECT level, CAST(cluster_level AS INTEGER) AS cluster_level, community, CAST(rn AS INTEGER) AS rn, id, source, target,
       CAST(tokens AS INTEGER) AS tokens, CAST(cum_tokens AS BIGINT) AS cum_tokens FROM (
  SELECT *, row_number() OVER w AS rn, sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tokens
  FROM ctx_r WINDOW w AS (PARTITION BY level, cluster_level, community ORDER BY rank DESC, id))
WHERE cum_tokens <= {C.REPORT_BUDGET}"""))
def community_context(spark, d):
    ctx = Ctx(spark, d)
    return R.community_context(ctx.assign, ctx.g.ranked_relationships)


@register("first_appearance_rank", with_ctes(GC + [
    """ctx_e AS (SELECT DISTINCT a.level, a.cluster_level, a.community, r.id, r.source, r.target, r.description, r.rank
  FROM ranked_relationships r JOIN assign a ON r.level = a.level AND (r.source = a.title OR r.target = a.title))""",
    """ctx_r AS (SELECT *, len(regexp_extract_all(concat_ws(',',
      '"' || replace(id, '"', '""') || '"', '"' || replace(source, '"', '""') || '"',
      '"' || replace(target, '"', '""') || '"', '"' || replace(description, '"', '""') || '"',
      CAST(rank AS VARCHAR)), '[^ \t\n\r\f]+')) AS tokens FROM ctx_e)""",
    f"""ctx_n AS (SELECT * FROM (
  SELECT *, row_number() OVER w AS rn, sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM ctx_r WINDOW w AS (PARTITION BY level, cluster_level, community ORDER BY rank DESC, id))
  WHERE cum <= {C.REPORT_BUDGET})""",
    """ends AS (SELECT level, cluster_level, community, rn, source AS title FROM ctx_n
  UNION ALL SELECT level, cluster_level, community, rn, target FROM ctx_n)"""], """
SELECT a.level, CAST(a.cluster_level AS INTEGER) AS cluster_level, a.community, a.title, CAST(min(e.rn) AS INTEGER) AS first_rn
FROM assign a JOIN ends e ON a.level = e.level AND a.cluster_level = e.cluster_level
  AND a.community = e.community AND a.title = e.title
GROUP BY a.level, a.cluster_level, a.community, a.title"""))
def first_appearance_rank(spark, d):
    """Members in order of first appearance in the ranked, budgeted edge list."""
    ctx = Ctx(spark, d)
    context = R.community_context(ctx.assign, ctx.g.ranked_relationships)
    fa = R.first_appearance(context, ctx.assign)
    return fa.select("level", "cluster_level", "community", "title", F.col("first_rn").cast("int").alias("first_rn"))


def _rollup_sql(depths: int = 12) -> list[str]:
    """The contexts of each cluster level from the one below it, level by level."""
    out = [
        """ctx_e AS (SELECT DISTINCT a.level, a.cluster_level, a.community, r.id, r.source, r.target, r.description, r.rank
  FROM ranked_relationships r JOIN assign a ON r.level = a.level AND (r.source = a.title OR r.target = a.title))""",
        f"""ctx_r AS (SELECT *, {ntok("""concat_ws(',', '"' || replace(id, '"', '""') || '"', '"' || replace(source, '"', '""') || '"',
      '"' || replace(target, '"', '""') || '"', '"' || replace(description, '"', '""') || '"', CAST(rank AS VARCHAR))""")} AS tokens FROM ctx_e)""",
        f"""ctx_b AS MATERIALIZED (SELECT u.level, u.cluster_level, u.community, u.parent, coalesce(o.own, 0) AS own, coalesce(o.kept, 0) AS kept,
         {ntok('r.full_content')} AS report
  FROM (SELECT DISTINCT level, cluster_level, community, parent FROM assign) u
  JOIN reports r USING (level, cluster_level, community)
  LEFT JOIN (SELECT level, cluster_level, community, max(cum) AS own, max(CASE WHEN cum <= {C.REPORT_BUDGET} THEN cum END) AS kept
             FROM (SELECT *, sum(tokens) OVER (PARTITION BY level, cluster_level, community ORDER BY rank DESC, id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM ctx_r)
             GROUP BY level, cluster_level, community) o USING (level, cluster_level, community))""",
        f"s{depths} AS (SELECT level, community, parent, report, CAST(kept AS HUGEINT) AS context FROM ctx_b WHERE cluster_level = {depths})"]
    for d in range(depths - 1, -1, -1):
        out += [
            f"""mix{d} AS MATERIALIZED (SELECT *, min(CASE WHEN reps + whole - run <= {C.REPORT_BUDGET} THEN rn END) OVER (PARTITION BY level, parent) AS least
  FROM (SELECT s.*, row_number() OVER w AS rn, sum(s.report) OVER (w ROWS UNBOUNDED PRECEDING) AS reps,
               sum(context) OVER (w ROWS UNBOUNDED PRECEDING) AS run, sum(context) OVER (PARTITION BY s.level, s.parent) AS whole
        FROM s{d + 1} s JOIN ctx_b p ON p.level = s.level AND p.community = s.parent AND p.cluster_level = {d} AND p.own > {C.REPORT_BUDGET}
        WINDOW w AS (PARTITION BY s.level, s.parent ORDER BY context DESC, s.community)))""",
            f"""part{d} AS MATERIALIZED (SELECT level, {d} AS cluster_level, parent AS community, community AS child, as_report, rn,
    CASE WHEN as_report THEN report ELSE context END AS tokens
  FROM (SELECT *, whole > {C.REPORT_BUDGET} AND rn <= coalesce(least, rn) AS as_report FROM mix{d})
  WHERE whole <= {C.REPORT_BUDGET} OR least IS NOT NULL OR reps <= {C.REPORT_BUDGET})""",
            f"""s{d} AS MATERIALIZED (SELECT b.level, b.community, b.parent, b.report, coalesce(t.t, b.kept) AS context FROM ctx_b b
  LEFT JOIN (SELECT level, community, sum(tokens) AS t FROM part{d} GROUP BY level, community) t USING (level, community)
  WHERE b.cluster_level = {d})"""]
    out.append("parts AS (" + " UNION ALL ".join(f"SELECT * FROM part{d}" for d in range(depths)) + ")")
    return out


@register("community_context_rollup", with_ctes(GR + _rollup_sql(), """
SELECT level, CAST(cluster_level AS INTEGER) AS cluster_level, community, child, as_report, CAST(rn AS INTEGER) AS rn,
       CAST(tokens AS BIGINT) AS tokens,
       CAST(sum(tokens) OVER (PARTITION BY level, cluster_level, community) AS BIGINT) AS context_tokens FROM parts"""))
def community_context_rollup(spark, d):
    """Contexts that overflow the report budget, rebuilt bottom-up from the children's
    contexts and reports."""
    ctx = Ctx(spark, d)
    return R.context_rollup(ctx.assign, ctx.g.ranked_relationships, ctx.reports)


@register("grounding_refs", with_ctes(GC, """
SELECT a.level, CAST(a.cluster_level AS INTEGER) AS cluster_level, a.community,
       '[Data: Entities (' || string_agg(e.id, ', ' ORDER BY e.id) FILTER (rk <= 5) ||
       CASE WHEN count(*) > 5 THEN ', +more' ELSE '' END || ')]' AS ref,
       count(*) AS n_members, CAST(0 AS BIGINT) AS n_missing
FROM (SELECT a.*, e.id, row_number() OVER (PARTITION BY a.level, a.cluster_level, a.community ORDER BY e.id) AS rk
      FROM assign a JOIN entities e ON a.level = e.level AND a.title = e.title) a
JOIN entities e ON e.id = a.id GROUP BY a.level, a.cluster_level, a.community"""))
def grounding_refs(spark, d):
    """The reference text of each community (five ids and ``+more``), and of all its members
    how many there are and how many no entity has."""
    ctx = Ctx(spark, d)
    keys = ["level", "cluster_level", "community"]
    members = ctx.assign.select(*keys, F.md5(F.concat_ws("|", "level", "title")).alias("id"))
    lost = R.missing_refs(members, "id", ctx.g.entity_stats).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_missing"))
    counts = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_members"))
    return (R.shown_refs(members, keys, "id").join(counts, keys).join(lost, keys, "left").fillna(0, ["n_missing"])
            .select("level", F.col("cluster_level").cast("int"), "community", "ref", "n_members", "n_missing"))


# ---------------------------------------------------------------- global search

@register("reports_at_level", with_ctes(GR, """
SELECT level, CAST(cluster_level AS INTEGER) AS cluster_level, community, title, rating FROM rep_lvl"""))
def reports_at_level(spark, d):
    ctx = Ctx(spark, d)
    r = S.reports_at_level(ctx.reports, ctx.assign)
    return r.select("level", F.col("cluster_level").cast("int"), "community", "title", "rating")


@register("finest_level_pick", with_ctes(GC, """
SELECT level, title, CAST(cluster_level AS INTEGER) AS cluster_level, community FROM (
  SELECT *, row_number() OVER (PARTITION BY level, title ORDER BY cluster_level DESC) AS r
  FROM assign WHERE cluster_level <= 2) WHERE r = 1"""))
def finest_level_pick(spark, d):
    f = S.finest_communities(Ctx(spark, d).assign)
    return f.select("level", "title", F.col("cluster_level").cast("int"), "community")


@register("entities_at_level", with_ctes(GC, """
SELECT f.level, f.title, CAST(f.cluster_level AS INTEGER) AS cluster_level, f.community, e.type, e.description
FROM (SELECT *, row_number() OVER (PARTITION BY level, title ORDER BY cluster_level DESC) AS r
      FROM assign WHERE cluster_level <= 2) f JOIN entities e ON f.level = e.level AND f.title = e.title
WHERE f.r = 1"""))
def entities_at_level(spark, d):
    ctx = Ctx(spark, d)
    f = S.finest_communities(ctx.assign)
    return f.join(ctx.g.entities, ["level", "title"]).select(
        "level", "title", F.col("cluster_level").cast("int"), "community", "type", "description")


@register("occurrence_weight", with_ctes(GS, """
SELECT level, community, n_units, occurrence_weight FROM gctx"""))
def occurrence_weight(spark, d):
    return Ctx(spark, d).gctx.select("level", "community", "n_units", "occurrence_weight")


@register("shuffle_reports", with_ctes(GS, """
SELECT level, community, shuffle_key, row_number() OVER (PARTITION BY level ORDER BY shuffle_key, community) AS place FROM gctx"""))
def shuffle_reports(spark, d):
    """The seeded order of each tier's reports, numbered without a task for a whole tier."""
    g = Ctx(spark, d).gctx.select("level", "community", "shuffle_key")
    n = global_row_number(g, [F.col("level"), F.col("shuffle_key"), F.col("community")], "_g")
    first = n.groupBy("level").agg(F.min("_g").alias("_g0"))
    return n.join(F.broadcast(first), "level").select("level", "community", "shuffle_key", (F.col("_g") - F.col("_g0") + 1).alias("place"))


@register("global_context", with_ctes(GS, """
SELECT level, CAST(cluster_level AS INTEGER) AS cluster_level, community, shuffle_key, occurrence_weight,
       rating, CAST(tokens AS INTEGER) AS tokens FROM gctx"""))
def global_context(spark, d):
    g = Ctx(spark, d).gctx
    return g.select("level", F.col("cluster_level").cast("int"), "community", "shuffle_key",
                    "occurrence_weight", "rating", F.col("tokens").cast("int"))


PACK = [
    """ord AS (SELECT level, community, tokens,
  row_number() OVER (PARTITION BY level ORDER BY shuffle_key, community) AS rn FROM gctx)""",
    f"""pack(level, rn, community, tokens, batch, used) AS (
  SELECT level, rn, community, tokens, 0, tokens FROM ord WHERE rn = 1
  UNION ALL
  SELECT o.level, o.rn, o.community, o.tokens,
         CASE WHEN p.used + o.tokens > {C.SEARCH_BUDGET} THEN p.batch + 1 ELSE p.batch END,
         CASE WHEN p.used + o.tokens > {C.SEARCH_BUDGET} THEN o.tokens ELSE p.used + o.tokens END
  FROM pack p JOIN ord o ON o.level = p.level AND o.rn = p.rn + 1)"""]


@register("batch_ids_by_tokens", with_ctes(GS + PACK, """
SELECT level, community, CAST(batch AS INTEGER) AS batch,
       CAST(sum(tokens) OVER (PARTITION BY level, batch) AS BIGINT) AS batch_tokens FROM pack"""))
def batch_ids_by_tokens(spark, d):
    """Greedy <= 12000-token batches of the shuffled report rows, one exact packing per tier."""
    g = Ctx(spark, d).gctx
    return greedy_pack(g, ["level"], "shuffle_key", "tokens", C.SEARCH_BUDGET, "community")


@register("global_map_score", with_ctes(GS + PACK, """
SELECT r.question_id, r.level, CAST(p.batch AS INTEGER) AS batch, count(*) AS n_points,
       CAST(sum(r.tokens) AS BIGINT) AS tokens, max(r.score) AS score
FROM greduce r JOIN pack p ON p.level = r.level AND p.community = r.community GROUP BY r.question_id, r.level, p.batch"""))
def global_map_score(spark, d):
    """The packed batches that give points to each question.  The SQL scores every pair of
    question and report that share a word; here most are never joined."""
    ctx = Ctx(spark, d)
    packed = greedy_pack(ctx.gctx, ["level"], "shuffle_key", "tokens", C.SEARCH_BUDGET, "community")
    return S.batch_scores(ctx.reduced, packed)


@register("global_reduce", with_ctes(GS, """
SELECT question_id, level, community, score, CAST(rn AS INTEGER) AS rn, CAST(cum_tokens AS BIGINT) AS cum_tokens
FROM greduce"""))
def global_reduce(spark, d):
    r = Ctx(spark, d).reduced
    return r.select("question_id", "level", "community", "score", F.col("rn").cast("int"),
                    F.col("cum_tokens").cast("long"))


@register("running_token_budget", with_ctes(GS, """
SELECT question_id, level, CAST(max(cum_tokens) AS BIGINT) AS used_tokens, count(*) AS n_reports
FROM greduce GROUP BY question_id, level"""))
def running_token_budget(spark, d):
    r = Ctx(spark, d).reduced
    return r.groupBy("question_id", "level").agg(F.max("cum_tokens").cast("long").alias("used_tokens"),
                                                 F.count(F.lit(1)).alias("n_reports"))


@register("clearance_query_single", with_ctes(GS, """
SELECT question_id, community, score, CAST(rn AS INTEGER) AS rn FROM greduce WHERE level = 'level_q'"""))
def clearance_query_single(spark, d):
    r = Ctx(spark, d).reduced.where(F.col("level") == "level_q")
    return r.select("question_id", "community", "score", F.col("rn").cast("int"))


@register("tiered_answer", with_ctes(GS, f"""
SELECT a.user_level, a.question_id, CAST(count(*) AS INTEGER) AS n_responses,
       'Please synthesize the following responses to answer the question:' || chr(10) || chr(10) ||
       string_agg('Response ' || CAST(a.i AS VARCHAR) || ':' || chr(10) || a.answer || chr(10) || chr(10), ''
                  ORDER BY a.i) || 'Question: ' || max(b.text) || 'Answer: ' AS prompt
FROM (SELECT a.*, c.user_level, row_number() OVER (PARTITION BY c.user_level, a.question_id ORDER BY
        CASE a.level WHEN 'general' THEN 1 WHEN 'level_q' THEN 2 ELSE 3 END) AS i
      FROM answers a JOIN {clearance_values('c')} ON a.level = c.level) a
JOIN benchmark b ON b.item_id = a.question_id
GROUP BY a.user_level, a.question_id"""))
def tiered_answer(spark, d):
    ctx = Ctx(spark, d)
    ans = S.answer_rows(ctx.reduced.where(F.col("rn") == 1), ctx.reports, "title")
    return S.tiered_answer(ans, ctx.questions, clearance_df(spark))


@register("answer_prompt", with_ctes(GS + [
    f"""said AS (SELECT question_id, level, string_agg(full_content, chr(10) || chr(10) ORDER BY rn) AS answer
  FROM (SELECT g.question_id, g.level, g.rn, r.full_content, sum({ntok('r.full_content')}) OVER (
          PARTITION BY g.question_id, g.level ORDER BY g.rn ROWS UNBOUNDED PRECEDING) AS cum
        FROM greduce g JOIN reports r USING (level, cluster_level, community))
  WHERE rn = 1 OR cum <= {C.ANSWER_BUDGET} GROUP BY question_id, level)""",
    f"""seen AS (SELECT c.user_level, a.question_id, a.answer, row_number() OVER (PARTITION BY c.user_level, a.question_id ORDER BY
    CASE a.level WHEN 'general' THEN 1 WHEN 'level_q' THEN 2 ELSE 3 END) AS i
  FROM said a JOIN {clearance_values('c')} ON a.level = c.level)"""], """
SELECT a.question_id, a.level, a.answer, CAST(s.n AS INTEGER) AS n_responses,
       'Please synthesize the following responses to answer the question:' || chr(10) || chr(10) || s.blocks
       || 'Question: ' || b.text || 'Answer: ' AS prompt
FROM said a JOIN (SELECT user_level, question_id, count(*) AS n,
       string_agg('Response ' || CAST(i AS VARCHAR) || ':' || chr(10) || answer || chr(10) || chr(10), '' ORDER BY i) AS blocks
     FROM seen GROUP BY user_level, question_id) s ON s.user_level = a.level AND s.question_id = a.question_id
JOIN (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL) b ON b.item_id = a.question_id"""))
def answer_prompt(spark, d):
    """The answer of each tier's search to a question, put together from all the points that
    were reduced, and the prompt of a user cleared for the tier: the numbered responses of
    the tiers below and of this one, and the question."""
    ctx = Ctx(spark, d)
    return S.answer_prompts(S.answer_rows(ctx.reduced, ctx.reports), ctx.questions, clearance_df(spark))


# ---------------------------------------------------------------- local search

@register("local_context", with_ctes(GL, """
SELECT question_id, level, section, item, CAST(rn AS INTEGER) AS rn, tokens, CAST(cum_tokens AS BIGINT) AS cum_tokens
FROM lctx"""))
def local_context(spark, d):
    ctx = Ctx(spark, d)
    return S.local_context(ctx.match(), ctx.reports, ctx.assign, ctx.g.entity_units, ctx.g.pair_rows,
                           ctx.g.units, ctx.g.ranked_relationships, ctx.g.degrees)


@register("local_text_unit_rank", with_ctes(GL, """
SELECT question_id, level, unit_id, entity_rk, CAST(n_rels AS BIGINT) AS n_rels FROM lunits"""))
def local_text_unit_rank(spark, d):
    ctx = Ctx(spark, d)
    return S.local_text_unit_rank(ctx.match(), ctx.g.entity_units, ctx.g.pair_rows)


@register("topk_relationships", with_ctes(GL, """
SELECT question_id, level, id, source, target, rank, CAST(rn AS INTEGER) AS rn, ends = 2 AS internal FROM lrels"""))
def topk_relationships(spark, d):
    ctx = Ctx(spark, d)
    return S.local_relationships(ctx.match(), ctx.g.ranked_relationships).select(
        "question_id", "level", "id", "source", "target", "rank", F.col("rn").cast("int"), "internal")


@register("topk_entities", with_ctes(GC, f"""
SELECT level, title, degree, CAST(r AS INTEGER) AS rk FROM (
  SELECT *, row_number() OVER (PARTITION BY level ORDER BY degree DESC, title) AS r FROM degrees)
WHERE r <= {C.TOP_K_ENTITIES}"""))
def topk_entities(spark, d):
    from pyspark.sql import Window
    deg = Ctx(spark, d).g.degrees
    w = Window.partitionBy("level").orderBy(F.col("degree").desc(), F.col("title"))
    return (deg.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= C.TOP_K_ENTITIES)
            .select("level", "title", "degree", F.col("rk").cast("int")))
