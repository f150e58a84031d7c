"""Registered queries: table verbs (projection, reshaping, joins, aggregation, sets).

Each verb runs on the stage table it operates on in the indexing pipeline.
Array-valued results are rendered as sorted, joined strings for the oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.windows import global_row_number
from strata.plans.registry import Ctx, register
from strata.plans.sqlgen import community_ctes, graph_ctes, units_ctes, with_ctes

G = graph_ctes()
GC = G + community_ctes()
U = units_ctes()


def _ments(ctx):
    """(unit_id, level, doc_id, pos, title, type) from the mention table."""
    return ctx.g.mentions.select("unit_id", "level", "doc_id", "pos", "title", "type")


# ---------------------------------------------------------------- 2.2 projections and reshaping

@register("select_columns", with_ctes(G, "SELECT level, title, type FROM entities"))
def select_columns(spark, d):
    return Ctx(spark, d).g.entity_stats.select("level", "title", "type")


@register("rename_columns", with_ctes(G, "SELECT level, source AS src, target AS tgt, weight FROM relationships"))
def rename_columns(spark, d):
    return Ctx(spark, d).g.edges.select("level", "source", "target", "weight") \
        .withColumnsRenamed({"source": "src", "target": "tgt"})


@register("drop_columns", with_ctes(G, "SELECT level, id, title, type, n_docs, n_units FROM entities"))
def drop_columns(spark, d):
    return Ctx(spark, d).g.entities.drop("description", "n_descriptions")


@register("copy_column", with_ctes(G, "SELECT level, title, title AS name FROM entities"))
def copy_column(spark, d):
    return Ctx(spark, d).g.entity_stats.select("level", "title").withColumn("name", F.col("title"))


@register("convert_types", with_ctes(U, """
SELECT id, CAST(chunk_ix AS VARCHAR) AS chunk_ix_str, CAST(n_tokens AS DOUBLE) AS n_tokens_dbl,
       CAST(doc_id AS INTEGER) AS doc_id_int, TRY_CAST(CAST(chunk_ix AS VARCHAR) AS INTEGER) AS chunk_ix_int,
       TRY_CAST(level AS INTEGER) AS level_int,
       array_to_string(string_split(text, chr(10)), '|') AS lines FROM units"""))
def convert_types(spark, d):
    """Numbers to strings and other numbers, strings to numbers (null where they hold none,
    as every tier name does), an array of lines to a string."""
    u = Ctx(spark, d).g.units
    return u.select("id", F.col("chunk_ix").cast("string").alias("chunk_ix_str"),
                    F.col("n_tokens").cast("double").alias("n_tokens_dbl"),
                    F.col("doc_id").cast("int").alias("doc_id_int"),
                    F.col("chunk_ix").cast("string").try_cast("int").alias("chunk_ix_int"),
                    F.col("level").try_cast("int").alias("level_int"),
                    F.array_join(F.split("text", "\n", -1), "|").alias("lines"))


@register("fill_nulls", """
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fill_nulls(spark, d):
    t = Ctx(spark, d).t
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").fillna(-1, ["quality", "toxic"])


@register("filter_rows", with_ctes(G, "SELECT level, title, n_docs FROM entities WHERE description <> '' AND n_docs >= 4"))
def filter_rows(spark, d):
    e = Ctx(spark, d).g.entities
    return e.where((F.col("description") != "") & (F.col("n_docs") >= 4)).select("level", "title", "n_docs")


@register("unroll_array", with_ctes(G, "SELECT unit_id, CAST(pos - 1 AS INTEGER) AS pos, title, type FROM mentions"))
def unroll_array(spark, d):
    """The array of a unit's mentions, in order (bounded: one unit), one row per element."""
    listed = _ments(Ctx(spark, d)).groupBy("unit_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "title", "type"))).alias("mentions"))
    return listed.select("unit_id", F.posexplode("mentions").alias("pos", "m")).select("unit_id", "pos", "m.title", "m.type")


@register("zip_unzip", with_ctes(G, """
SELECT unit_id, CAST(pos - 1 AS INTEGER) AS i, title || '/' || type AS pair, title, type FROM mentions"""))
def zip_unzip(spark, d):
    """titles and types of a unit collected in order (bounded: one unit),
    zipped into one array of pairs, then unzipped."""
    m = _ments(Ctx(spark, d))
    arr = m.groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("pos", "title", "type"))).alias("a"))
    z = arr.select("unit_id", F.arrays_zip(F.transform("a", lambda x: x["title"]).alias("t"),
                                           F.transform("a", lambda x: x["type"]).alias("y")).alias("z"))
    return z.select("unit_id", F.posexplode("z").alias("i", "p")).select(
        "unit_id", F.col("i").cast("int"), F.concat_ws("/", "p.t", "p.y").alias("pair"),
        F.col("p.t").alias("title"), F.col("p.y").alias("type"))


@register("gen_id", with_ctes(U, """
SELECT doc_id, chunk_ix, md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(chunk_ix AS VARCHAR))) AS gen_id FROM units"""))
def gen_id(spark, d):
    u = Ctx(spark, d).g.units
    return u.select("doc_id", "chunk_ix", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"),
                                                            F.col("chunk_ix").cast("string"))).alias("gen_id"))


@register("merge_columns", with_ctes(G, """SELECT level, title, '"' || title || '":' || description AS merged FROM entities"""))
def merge_columns(spark, d):
    e = Ctx(spark, d).g.entities
    return e.select("level", "title", F.concat(F.lit('"'), "title", F.lit('":'), "description").alias("merged"))


@register("split_text_column", """
SELECT conv_id, turn, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
       string_split(text, chr(10))[1] AS first_line FROM conversations""")
def split_text_column(spark, d):
    c = Ctx(spark, d).t.conversations
    parts = F.split("text", "\n")
    return c.select("conv_id", "turn", F.size(parts).alias("n_lines"), parts[0].alias("first_line"))


@register("dedupe_rows", """
SELECT md5(text) AS text_hash, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY md5(text)""")
def dedupe_rows(spark, d):
    """Exact-copy dedupe keeping the smallest id: a combinable min per
    content hash, so a hash shared by a third of all rows is still merged
    map-side (no window over the hot group)."""
    docs = Ctx(spark, d).t.documents
    return docs.groupBy(F.md5("text").alias("text_hash")).agg(F.min("doc_id").alias("doc_id"),
                                                              F.count(F.lit(1)).alias("n_copies"))


@register("order_rows", with_ctes(G, """
SELECT level, title, n_docs, row_number() OVER (ORDER BY n_docs DESC, level, title) AS row_id FROM entities"""))
def order_rows(spark, d):
    e = Ctx(spark, d).g.entity_stats.select("level", "title", "n_docs")
    return global_row_number(e, [F.col("n_docs").desc(), F.col("level"), F.col("title")])


# ---------------------------------------------------------------- 2.6 joins

@register("join_node_attributes", with_ctes(GC, """
SELECT a.level, a.title, CAST(a.cluster_level AS INTEGER) AS cluster_level, a.community, e.type, d.degree
FROM assign a JOIN entities e ON a.level = e.level AND a.title = e.title
JOIN degrees d ON a.level = d.level AND a.title = d.title"""))
def join_node_attributes(spark, d):
    ctx = Ctx(spark, d)
    return (ctx.assign.join(ctx.g.entity_stats.select("level", "title", "type"), ["level", "title"])
            .join(ctx.g.degrees, ["level", "title"])
            .select("level", "title", F.col("cluster_level").cast("int"), "community", "type", "degree"))


@register("join_community_endpoints", with_ctes(GC, """
SELECT a.level, CAST(a.cluster_level AS INTEGER) AS cluster_level, a.community, r.id, 'source' AS side
FROM relationships r JOIN assign a ON r.level = a.level AND r.source = a.title
UNION ALL
SELECT a.level, CAST(a.cluster_level AS INTEGER), a.community, r.id, 'target'
FROM relationships r JOIN assign a ON r.level = a.level AND r.target = a.title"""))
def join_community_endpoints(spark, d):
    ctx = Ctx(spark, d)
    a = ctx.assign.select("level", "title", F.col("cluster_level").cast("int"), "community")
    r = ctx.g.edges.select("level", "id", "source", "target")
    s = r.join(a.withColumnRenamed("title", "source"), ["level", "source"]).select(
        "level", "cluster_level", "community", "id", F.lit("source").alias("side"))
    t = r.join(a.withColumnRenamed("title", "target"), ["level", "target"]).select(
        "level", "cluster_level", "community", "id", F.lit("target").alias("side"))
    return s.unionByName(t)


@register("concat_tables", with_ctes(GC, """
SELECT level, CAST(cluster_level AS INTEGER) AS cluster_level, community, count(*) AS n_endpoints FROM (
  SELECT a.level, a.cluster_level, a.community FROM relationships r JOIN assign a ON r.level = a.level AND r.source = a.title
  UNION ALL
  SELECT a.level, a.cluster_level, a.community FROM relationships r JOIN assign a ON r.level = a.level AND r.target = a.title)
GROUP BY level, cluster_level, community"""))
def concat_tables(spark, d):
    e = join_community_endpoints(spark, d)
    return e.groupBy("level", "cluster_level", "community").agg(F.count(F.lit(1)).alias("n_endpoints"))


@register("join_community_left", with_ctes(GC, """
SELECT c.level, c.community, c.size, coalesce(e.n_edges, 0) AS n_edges FROM
  (SELECT level, community, count(*) AS size FROM assign WHERE cluster_level = 0 GROUP BY level, community) c
LEFT JOIN (SELECT s.level, s.community, count(*) AS n_edges FROM relationships r
           JOIN assign s ON r.level = s.level AND r.source = s.title AND s.cluster_level = 0
           JOIN assign t ON r.level = t.level AND r.target = t.title AND t.cluster_level = 0
           WHERE s.community = t.community GROUP BY s.level, s.community) e
  ON c.level = e.level AND c.community = e.community"""))
def join_community_left(spark, d):
    from strata.operators.reports import internal_edges
    ctx = Ctx(spark, d)
    a0 = ctx.assign.where(F.col("cluster_level") == 0)
    sizes = a0.groupBy("level", "community").agg(F.count(F.lit(1)).alias("size"))
    ne = internal_edges(a0, ctx.g.edges).groupBy("level", "community").agg(F.count(F.lit(1)).alias("n_edges"))
    return sizes.join(ne, ["level", "community"], "left").fillna(0, ["n_edges"])


@register("join_units_to_entities", with_ctes(G, """
SELECT unit_id, string_agg(DISTINCT id, ',' ORDER BY id) AS entity_ids, count(DISTINCT id) AS n_entities
FROM (SELECT q.unit_id, e.id FROM q_unit_ents q JOIN entities e ON q.level = e.level AND q.title = e.title)
GROUP BY unit_id"""))
def join_units_to_entities(spark, d):
    ctx = Ctx(spark, d)
    eu = ctx.g.entity_units.join(ctx.g.entity_stats.select("level", "title", "id"), ["level", "title"])
    # bounded group: the entities of one text unit (<= its token count)
    return eu.groupBy("unit_id").agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("entity_ids"),
                                     F.countDistinct("id").alias("n_entities"))


@register("join_units_to_relationships", with_ctes(G, """
SELECT p.unit_id, string_agg(DISTINCT r.id, ',' ORDER BY r.id) AS relationship_ids, count(DISTINCT r.id) AS n_relationships
FROM pair_rows p JOIN relationships r ON p.level = r.level AND p.source = r.source AND p.target = r.target
GROUP BY p.unit_id"""))
def join_units_to_relationships(spark, d):
    ctx = Ctx(spark, d)
    pr = ctx.g.pair_rows.join(ctx.g.edges.select("level", "source", "target", "id"),
                              ["level", "source", "target"])
    return pr.groupBy("unit_id").agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("relationship_ids"),
                                     F.countDistinct("id").alias("n_relationships"))


@register("final_text_units", with_ctes(G, """
SELECT u.id, u.doc_id, u.n_tokens, coalesce(e.n, 0) AS n_entities, coalesce(r.n, 0) AS n_relationships
FROM units u
LEFT JOIN (SELECT unit_id, count(DISTINCT title) AS n FROM q_unit_ents GROUP BY unit_id) e ON e.unit_id = u.id
LEFT JOIN (SELECT unit_id, count(*) AS n FROM pair_rows GROUP BY unit_id) r ON r.unit_id = u.id"""))
def final_text_units(spark, d):
    g = Ctx(spark, d).g
    e = g.entity_units.groupBy("unit_id").agg(F.countDistinct("title").alias("n_entities"))
    r = g.pair_rows.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n_relationships"))
    u = g.units.select("id", "doc_id", "n_tokens")
    return (u.join(e, u.id == e.unit_id, "left").drop("unit_id").join(r, u.id == r.unit_id, "left").drop("unit_id")
            .fillna(0, ["n_entities", "n_relationships"]))


@register("final_documents", with_ctes(U, """
SELECT d.doc_id, d.level, coalesce(u.n, 0) AS n_units, coalesce(u.ids, '') AS unit_ids FROM docs d
LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY chunk_ix) AS ids FROM units GROUP BY doc_id) u
  USING (doc_id)"""))
def final_documents(spark, d):
    from strata.operators.chunks import with_tier
    ctx = Ctx(spark, d)
    agg = (ctx.g.units.groupBy("doc_id")
           .agg(F.count(F.lit(1)).alias("n_units"),
                F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_ix", "id"))), lambda s: s["id"]),
                             ",").alias("unit_ids")))
    docs = with_tier(ctx.t.documents).select("doc_id", "level")
    return docs.join(agg, "doc_id", "left").fillna(0, ["n_units"]).fillna("", ["unit_ids"])


@register("gazetteer_semi_join", with_ctes(G, """
SELECT m.level, m.title, count(*) AS n_mentions FROM mentions m
WHERE EXISTS (SELECT 1 FROM qualified q WHERE q.level = m.level AND q.title = m.title)
GROUP BY m.level, m.title"""))
def gazetteer_semi_join(spark, d):
    """Mentions kept when their (tier, title) is in the entity gazetteer.
    The gazetteer grows with the corpus, so this is a plain semi join
    (AQE may still broadcast it when its measured size is small)."""
    ctx = Ctx(spark, d)
    m = _ments(ctx)
    return (m.join(ctx.g.qualified.select("level", "title"), ["level", "title"], "left_semi")
            .groupBy("level", "title").agg(F.count(F.lit(1)).alias("n_mentions")))


# ---------------------------------------------------------------- 2.7 aggregations

@register("agg_collect_list", with_ctes(G, """
SELECT unit_id, string_agg(title, ',' ORDER BY pos) AS titles FROM mentions GROUP BY unit_id"""))
def agg_collect_list(spark, d):
    m = _ments(Ctx(spark, d))
    # bounded group: mentions of one text unit
    return m.groupBy("unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))),
                                                             lambda s: s["title"]), ",").alias("titles"))


@register("agg_collect_distinct", with_ctes(G, """
SELECT unit_id, string_agg(DISTINCT title, ',' ORDER BY title) AS titles FROM mentions GROUP BY unit_id"""))
def agg_collect_distinct(spark, d):
    m = _ments(Ctx(spark, d))
    return m.groupBy("unit_id").agg(F.array_join(F.array_sort(F.collect_set("title")), ",").alias("titles"))


@register("agg_flatten_distinct", with_ctes(G, """
SELECT doc_id, string_agg(DISTINCT title, ',' ORDER BY title) AS titles FROM mentions GROUP BY doc_id"""))
def agg_flatten_distinct(spark, d):
    """Per document: the union of its units' distinct-title arrays."""
    m = _ments(Ctx(spark, d))
    per_unit = m.groupBy("doc_id", "unit_id").agg(F.collect_set("title").alias("ts"))
    # bounded group: the units of one document
    return per_unit.groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ts")))), ",").alias("titles"))


@register("num_documents", "SELECT count(*) AS num_documents FROM documents")
def num_documents(spark, d):
    return Ctx(spark, d).t.documents.select(F.count(F.lit(1)).alias("num_documents"))


# ---------------------------------------------------------------- 2.10 set operations

@register("distinct_titles_across_tiers", with_ctes(G, """
SELECT title, count(*) AS n_tiers FROM entities GROUP BY title"""))
def distinct_titles_across_tiers(spark, d):
    return Ctx(spark, d).g.entity_stats.groupBy("title").agg(F.count(F.lit(1)).alias("n_tiers"))
