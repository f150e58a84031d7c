"""Registered queries: text units, extraction, graph merge, communities."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import config as C
from strata.functions.text import token_count, tokens
from strata.operators import communities as com
from strata.operators import extract
from strata.operators.chunks import truncate_tokens, word_chunks
from strata.plans.registry import Ctx, register
from strata.plans.sqlgen import WS, community_ctes, graph_ctes, ntok, type_sql, units_ctes, with_ctes

G = graph_ctes()
GC = G + community_ctes()
U = units_ctes()


# ---------------------------------------------------------------- 2.3 text units

@register("token_chunks", with_ctes(U, "SELECT id, doc_id, level, chunk_ix, text, n_tokens FROM units"))
def token_chunks(spark, d):
    return Ctx(spark, d).g.units


@register("word_chunks", f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_ix, document_text FROM (
  SELECT doc_id, unnest(parts) AS document_text, generate_subscripts(parts, 1) AS i FROM (
    SELECT doc_id, CASE WHEN len(toks) > {C.WORD_CHUNK}
      THEN list_transform(range(0, len(toks), {C.WORD_STRIDE}),
                          lambda s: array_to_string(toks[s + 1 : s + {C.WORD_CHUNK}], ' '))
      ELSE [text] END AS parts
    FROM (SELECT doc_id, text, regexp_extract_all(text, {WS}) AS toks FROM documents)))""")
def q_word_chunks(spark, d):
    from strata.sources.tables import spread_small
    return word_chunks(spread_small(Ctx(spark, d).t.documents))


@register("chunk_group_concat", with_ctes(U, """
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_units,
       string_agg(id, ',' ORDER BY chunk_ix) AS unit_ids FROM units GROUP BY doc_id"""))
def chunk_group_concat(spark, d):
    u = Ctx(spark, d).g.units
    # bounded group: the units of one document, ordered by chunk index
    return (u.groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("n_units"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_ix", "id"))),
                                          lambda s: s["id"]), ",").alias("unit_ids")))


@register("token_count", f"""
SELECT doc_id, CAST({ntok('text')} AS INTEGER) AS n_tokens FROM documents WHERE {ntok('text')} > 0""")
def q_token_count(spark, d):
    docs = Ctx(spark, d).t.documents
    return docs.select("doc_id", token_count(F.col("text")).alias("n_tokens")).where(F.col("n_tokens") > 0)


@register("truncate_tokens", f"""
SELECT doc_id, array_to_string(regexp_extract_all(text, {WS})[1 : {C.EMBED_TRUNCATE}], ' ') AS text_512,
       CAST(least({ntok('text')}, {C.EMBED_TRUNCATE}) AS INTEGER) AS n_tokens FROM documents""")
def q_truncate(spark, d):
    docs = Ctx(spark, d).t.documents
    return docs.select("doc_id", truncate_tokens(F.col("text")).alias("text_512"),
                       F.least(F.size(tokens(F.col("text"))), F.lit(C.EMBED_TRUNCATE)).alias("n_tokens"))


@register("text_unit_document_links", with_ctes(U, """
SELECT 'unit' AS side, id AS key, CAST(doc_id AS VARCHAR) AS linked, CAST(1 AS BIGINT) AS n FROM units
UNION ALL
SELECT 'document', CAST(doc_id AS VARCHAR), CAST(min(id) AS VARCHAR), count(*) FROM units GROUP BY doc_id"""))
def unit_doc_links(spark, d):
    u = Ctx(spark, d).g.units
    fwd = u.select(F.lit("unit").alias("side"), F.col("id").alias("key"),
                   F.col("doc_id").cast("string").alias("linked"), F.lit(1).cast("long").alias("n"))
    back = (u.groupBy("doc_id").agg(F.min("id").alias("linked"), F.count(F.lit(1)).alias("n"))
            .select(F.lit("document").alias("side"), F.col("doc_id").cast("string").alias("key"), "linked", "n"))
    return fwd.unionByName(back)


# ---------------------------------------------------------------- 2.4 extraction

@register("extract_entities", with_ctes(G, """
SELECT level, id, title, type, description, n_docs, n_units, n_descriptions FROM entities"""))
def extract_entities(spark, d):
    return Ctx(spark, d).g.entities


@register("extract_relationships", with_ctes(G, """
SELECT level, unit_id, source, target, strength, description FROM pair_rows"""))
def extract_relationships(spark, d):
    return Ctx(spark, d).g.pair_rows.select("level", "unit_id", "source", "target", "strength", "description")


@register("entity_type_filter", with_ctes(G, f"""
SELECT m.level, m.type, CAST(count(*) AS BIGINT) AS n_mentions FROM (
  SELECT id AS unit_id, level, upper(w) AS title, {type_sql('upper(w)')} AS type
  FROM sent_words) m
WHERE EXISTS (SELECT 1 FROM (VALUES {', '.join(f"('{t}', '{ty}')" for t, tys in C.TIER_TYPES.items() for ty in tys)})
              AS a(level, type) WHERE a.level = m.level AND a.type = m.type)
GROUP BY m.level, m.type"""))
def entity_type_filter(spark, d):
    """Mentions of every type, then a semi-join on the (tier, type) allow
    list: a fixed, tiny table, so broadcasting it is size-safe."""
    ctx = Ctx(spark, d)
    allowed = spark.createDataFrame([(t, ty) for t, tys in C.TIER_TYPES.items() for ty in tys],
                                    "level string, type string")
    ms = extract.mentions(ctx.g.units, type_filter=False).select("level", "type")
    return (ms.join(F.broadcast(allowed), ["level", "type"], "left_semi")
            .groupBy("level", "type").agg(F.count(F.lit(1)).alias("n_mentions")))


def _records(ctx):
    return extract.format_records(ctx.g.unit_entities, ctx.g.unit_relationships)


@register("parse_extraction_records", with_ctes(G, """
SELECT kind, CAST(count(*) AS BIGINT) AS n_records, CAST(count(DISTINCT f1) AS BIGINT) AS n_names,
       CAST(sum(coalesce(strength, 0)) AS DOUBLE) AS total_strength
FROM (SELECT 'entity' AS kind, title AS f1, NULL AS strength FROM unit_ents
      UNION ALL SELECT 'relationship', source, CAST(strength AS DOUBLE) FROM unit_rels)
GROUP BY kind"""))
def parse_extraction_records(spark, d):
    """Round trip: rule extraction -> record strings -> parser."""
    p = extract.parse_records(_records(Ctx(spark, d)))
    return (p.where("valid").groupBy("kind")
            .agg(F.count(F.lit(1)).alias("n_records"), F.countDistinct("f1").alias("n_names"),
                 F.coalesce(F.sum("strength"), F.lit(0.0)).cast("double").alias("total_strength")))


# ---------------------------------------------------------------- 2.5 graph

@register("merge_entities", with_ctes(G, """
SELECT level, title, n_docs, n_units, n_descriptions FROM entities"""))
def merge_entities(spark, d):
    return Ctx(spark, d).g.entities.select("level", "title", "n_docs", "n_units", "n_descriptions")


@register("merge_relationships", with_ctes(G, """
SELECT level, id, source, target, description, weight, n_units FROM relationships"""))
def merge_relationships(spark, d):
    return Ctx(spark, d).g.relationships


@register("summarize_descriptions", with_ctes(G, """
SELECT 'entity' AS kind, title AS name, description FROM entities WHERE n_descriptions >= 2
UNION ALL
SELECT 'relationship', source || '|' || target, r.description FROM relationships r
JOIN (SELECT level, source, target FROM pair_rows WHERE description <> ''
      GROUP BY level, source, target HAVING count(DISTINCT description) >= 2) k
  USING (level, source, target)"""))
def summarize_descriptions(spark, d):
    g = Ctx(spark, d).g
    e = g.entities.where(F.col("n_descriptions") >= 2).select(
        F.lit("entity").alias("kind"), F.col("title").alias("name"), "description")
    r = g.summarized_relationships.select(
        F.lit("relationship").alias("kind"), F.concat_ws("|", "source", "target").alias("name"), "description")
    return e.unionByName(r)


@register("unpack_nodes", with_ctes(G, "SELECT level, title, type, degree FROM entities JOIN degrees USING (level, title)"))
def unpack_nodes(spark, d):
    g = Ctx(spark, d).g
    return g.entity_stats.select("level", "title", "type").join(g.degrees, ["level", "title"])


@register("unpack_edges", with_ctes(G, "SELECT level, source, target, weight FROM relationships"))
def unpack_edges(spark, d):
    return Ctx(spark, d).g.edges.select("level", "source", "target", "weight")


@register("node_degree", with_ctes(G, "SELECT level, title, degree FROM degrees"))
def node_degree(spark, d):
    return Ctx(spark, d).g.degrees


@register("edge_combined_degree", with_ctes(G, "SELECT level, id, source, target, rank FROM ranked_relationships"))
def edge_combined_degree(spark, d):
    return Ctx(spark, d).g.ranked_edges


@register("cluster_graph", with_ctes(GC, "SELECT level, title, cluster_level, community, parent FROM assign"))
def cluster_graph(spark, d):
    return Ctx(spark, d).assign.select("level", "title", F.col("cluster_level").cast("int"), "community", "parent")


@register("community_modularity", with_ctes(GC + [
    """down AS (SELECT level, title, unnest(range(cluster_level, coalesce(nxt, deepest + 1))) AS cluster_level, community FROM (
  SELECT *, lead(cluster_level) OVER (PARTITION BY level, title ORDER BY cluster_level) AS nxt,
         max(cluster_level) OVER (PARTITION BY level) AS deepest FROM assign))""",
    "m AS (SELECT level, sum(weight) AS m FROM relationships GROUP BY level)",
    """k AS (SELECT level, title, sum(weight) AS k FROM (
  SELECT level, source AS title, weight FROM relationships UNION ALL SELECT level, target, weight FROM relationships)
  GROUP BY level, title)""",
    """tot AS (SELECT a.level, a.cluster_level, a.community, sum(k.k) AS tot FROM down a
  JOIN k ON a.level = k.level AND a.title = k.title GROUP BY a.level, a.cluster_level, a.community)""",
    """inn AS (SELECT s.level, s.cluster_level, s.community, sum(r.weight) AS inw FROM relationships r
  JOIN down s ON r.level = s.level AND r.source = s.title
  JOIN down t ON r.level = t.level AND r.target = t.title AND s.cluster_level = t.cluster_level
  WHERE s.community = t.community GROUP BY s.level, s.cluster_level, s.community)"""], """
SELECT tot.level, CAST(tot.cluster_level AS INTEGER) AS cluster_level,
       round(sum(coalesce(inw, 0) / m.m - pow(tot / (2 * m.m), 2)), 6) AS modularity,
       count(*) AS n_communities
FROM tot LEFT JOIN inn USING (level, cluster_level, community) JOIN m USING (level)
GROUP BY tot.level, tot.cluster_level"""))
def community_modularity(spark, d):
    ctx = Ctx(spark, d)
    m = com.modularity(ctx.assign, ctx.g.edges)
    return m.select("level", F.col("cluster_level").cast("int"), F.round("modularity", 6).alias("modularity"),
                    "n_communities")


@register("restore_hierarchy", with_ctes(GC, """
SELECT DISTINCT level, CAST(cluster_level AS INTEGER) AS cluster_level, community, parent
FROM assign WHERE parent IS NOT NULL"""))
def restore_hierarchy(spark, d):
    a = Ctx(spark, d).assign
    return a.where(F.col("parent").isNotNull()).select(
        "level", F.col("cluster_level").cast("int"), "community", "parent").distinct()


@register("community_members", with_ctes(GC, """
SELECT a.level, CAST(a.cluster_level AS INTEGER) AS cluster_level, a.community, count(*) AS size,
       CAST(coalesce(max(e.n_edges), 0) AS BIGINT) AS n_edges, CAST(coalesce(max(u.n_units), 0) AS BIGINT) AS n_units
FROM assign a
LEFT JOIN (SELECT s.level, s.cluster_level, s.community, count(*) AS n_edges FROM relationships r
           JOIN assign s ON r.level = s.level AND r.source = s.title
           JOIN assign t ON r.level = t.level AND r.target = t.title AND s.cluster_level = t.cluster_level
           WHERE s.community = t.community GROUP BY s.level, s.cluster_level, s.community) e
  ON a.level = e.level AND a.cluster_level = e.cluster_level AND a.community = e.community
LEFT JOIN (SELECT x.level, x.cluster_level, x.community, count(DISTINCT q.unit_id) AS n_units
           FROM assign x JOIN q_unit_ents q ON x.level = q.level AND x.title = q.title
           GROUP BY x.level, x.cluster_level, x.community) u
  ON a.level = u.level AND a.cluster_level = u.cluster_level AND a.community = u.community
GROUP BY a.level, a.cluster_level, a.community"""))
def community_members(spark, d):
    from strata.operators.reports import community_stats
    ctx = Ctx(spark, d)
    return community_stats(ctx.assign, ctx.g.edges, ctx.g.entity_units)


@register("level_node_counts", with_ctes(GC, """
SELECT level, CAST(cluster_level AS INTEGER) AS cluster_level, count(*) AS n_nodes,
       count(DISTINCT community) AS n_communities FROM assign GROUP BY level, cluster_level"""))
def level_node_counts(spark, d):
    a = Ctx(spark, d).assign
    return a.groupBy("level", F.col("cluster_level").cast("int").alias("cluster_level")).agg(
        F.count(F.lit(1)).alias("n_nodes"), F.countDistinct("community").alias("n_communities"))


@register("distinct_nodes", with_ctes(G, "SELECT DISTINCT title FROM entities"))
def distinct_nodes(spark, d):
    return Ctx(spark, d).g.entity_stats.select("title").distinct()


@register("node2vec_embed")
def node2vec_embed(spark, d):
    """Random walks (10 x 40) + Word2Vec (window 2, 3 iterations), per tier."""
    from strata.operators.walks import node2vec
    ctx = Ctx(spark, d)
    v = node2vec(ctx.g.entity_stats, ctx.g.edges)
    return v.select("level", "title", F.size("vector").alias("dim"))
