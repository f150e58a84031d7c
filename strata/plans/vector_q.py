"""Registered queries: vector tables, embeddings, PCA and nearest-neighbour search."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import config as C
from strata.operators import vectors as V
from strata.operators.chunks import word_chunks
from strata.plans.registry import Ctx, register
from strata.plans.sqlgen import WS, embed_sql, entity_match_ctes, graph_ctes, q, with_ctes

VALID_VECTORS = """dimq AS (SELECT len(embedding) AS d FROM embeddings GROUP BY len(embedding)
                ORDER BY count(*) DESC, d LIMIT 1),
valid AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
          WHERE len(embedding) = (SELECT d FROM dimq)
            AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0)"""

CENTROIDS = """cent AS (SELECT label, list(x ORDER BY i) AS c FROM (
    SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM valid)
    GROUP BY label, i) GROUP BY label)"""


def valid_vectors(ctx: Ctx):
    e = ctx.t.embeddings
    return V.split_valid(e, V.vector_dim(e))


def label_queries(valid):
    return V.centroids(valid, "label").select(F.col("label").cast("long").alias("query_id"), "vector")


@register("vector_topk_cosine", f"""
WITH {VALID_VECTORS}, {CENTROIDS}
SELECT query_id, vec_id, score, CAST(rk AS INTEGER) AS rk FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk
  FROM (SELECT CAST(c.label AS BIGINT) AS query_id, v.vec_id,
               round(list_cosine_similarity(c.c, v.v) + 1.0, 6) AS score FROM cent c, valid v))
WHERE rk <= {C.VECTOR_TOP_K}""")
def vector_topk_cosine(spark, d):
    """Top 5 vectors by cosine + 1 for every label centroid query."""
    valid, _ = valid_vectors(Ctx(spark, d))
    return V.topk_cosine(valid.select("vec_id", "embedding"), label_queries(valid))


@register("search_size_5", f"""
WITH {VALID_VECTORS}, {CENTROIDS}
SELECT query_id, CAST(count(*) AS BIGINT) AS n_hits, round(max(score), 6) AS best, round(min(score), 6) AS worst FROM (
  SELECT query_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk
  FROM (SELECT CAST(c.label AS BIGINT) AS query_id, v.vec_id,
               round(list_cosine_similarity(c.c, v.v) + 1.0, 6) AS score FROM cent c, valid v))
WHERE rk <= {C.VECTOR_TOP_K} GROUP BY query_id""")
def search_size_5(spark, d):
    valid, _ = valid_vectors(Ctx(spark, d))
    r = V.topk_cosine(valid.select("vec_id", "embedding"), label_queries(valid))
    return r.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"), F.round(F.max("score"), 6).alias("best"),
                                     F.round(F.min("score"), 6).alias("worst"))


@register("vector_table_replace", f"""
WITH {VALID_VECTORS}
SELECT vec_id, label, CAST(len(v) AS INTEGER) AS dim FROM valid""")
def vector_table_replace(spark, d):
    """Recreate the vector table with its declared dim: rows of another
    length or zero norm go to quarantine (written beside it)."""
    from strata.sources.sinks import write_vector_table
    ctx = Ctx(spark, d)
    valid, bad = valid_vectors(ctx)
    path = write_vector_table(spark, valid, bad, "vectors")
    return spark.read.parquet(path).select("vec_id", "label", F.size("embedding").alias("dim"))


@register("vector_sink", f"""
WITH {VALID_VECTORS}
SELECT vec_id, embedding, label FROM embeddings WHERE vec_id IN (SELECT vec_id FROM valid)""")
def vector_sink(spark, d):
    """Bulk write (id, vector) rows; merge by id on re-run: a second write of
    the same rows adds none (left_anti + append)."""
    from strata.sources.sinks import merge_by_id
    ctx = Ctx(spark, d)
    valid, _ = valid_vectors(ctx)
    from strata.session import scratch_path
    path = scratch_path(spark, "vector-sink")
    merge_by_id(spark, valid, path, "vec_id")
    merge_by_id(spark, valid, path, "vec_id")          # idempotent re-run
    return spark.read.parquet(path).select("vec_id", "embedding", "label")


@register("vector_math", """
SELECT vec_id, round(sqrt(list_inner_product(v, v)), 6) AS norm,
       round(list_sum(v) / len(v), 6) AS mean,
       round(list_inner_product(v, v) / sqrt(list_inner_product(v, v)) / sqrt(list_inner_product(v, v)), 6) AS self_cosine,
       round(list_max(list_transform(v, lambda x: abs(x))), 6) AS max_abs
FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE len(embedding) > 0)
WHERE list_inner_product(v, v) > 0""")
def vector_math(spark, d):
    e = Ctx(spark, d).t.embeddings.where(F.size("embedding") > 0)
    v = F.transform("embedding", lambda x: x.cast("double"))
    dot = F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    s = F.aggregate(v, F.lit(0.0), lambda a, b: a + b)
    mx = F.array_max(F.transform(v, lambda x: F.abs(x)))
    return e.where(dot > 0).select("vec_id", F.round(F.sqrt(dot), 6).alias("norm"),
                                   F.round(s / F.size("embedding"), 6).alias("mean"),
                                   F.round(dot / F.sqrt(dot) / F.sqrt(dot), 6).alias("self_cosine"),
                                   F.round(mx, 6).alias("max_abs"))


@register("entity_vector_match", with_ctes(graph_ctes() + entity_match_ctes(),
                                          "SELECT question_id, level, title, score, rk FROM ematch"))
def entity_vector_match(spark, d):
    """Question -> 10 nearest entities of each tier (embedding of "TITLE":description)."""
    from strata.operators.search import entity_match
    ctx = Ctx(spark, d)
    return entity_match(ctx.g.entities, ctx.questions)


@register("embed_text", f"""
SELECT doc_id, CAST({V.EMBED_DIM} AS INTEGER) AS dim, CAST(1.0 AS DOUBLE) AS norm2 FROM documents
WHERE len(regexp_extract_all(lower(text), {q(V.EMBED_WORD_RE)})) > 0""")
def embed_text(spark, d):
    from strata.sources.tables import spread_small
    docs = spread_small(Ctx(spark, d).t.documents)
    e = V.embed_text(docs, "doc_id", "text")
    return e.select("doc_id", F.size("embedding").alias("dim"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, b: a + b * b), 6).alias("norm2"))


@register("embed_corpus", f"""
WITH ch AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_ix, document_text, doc_id || ':' || (i - 1) AS chunk_id FROM (
    SELECT doc_id, unnest(parts) AS document_text, generate_subscripts(parts, 1) AS i FROM (
      SELECT doc_id, CASE WHEN len(toks) > {C.WORD_CHUNK}
        THEN list_transform(range(0, len(toks), {C.WORD_STRIDE}),
                            lambda s: array_to_string(toks[s + 1 : s + {C.WORD_CHUNK}], ' '))
        ELSE [text] END AS parts
      FROM (SELECT doc_id, text, regexp_extract_all(text, {WS}) AS toks FROM documents)))),
{embed_sql("ch", "chunk_id", "document_text", "cv")},
dense AS (SELECT t.id, map_from_entries(list(struct_pack(k := t.bucket, v := t.tf / n.n))) AS m
          FROM cv_t t JOIN cv_n n USING (id) GROUP BY t.id)
SELECT ch.doc_id, ch.chunk_ix, ch.document_text,
       list_transform(range(0, {V.EMBED_DIM}), lambda i: coalesce(d.m[i], 0.0)) AS embedding
FROM ch JOIN dense d ON d.id = ch.chunk_id""")
def embed_corpus(spark, d):
    """documents -> word chunks -> vectors (the directory-embedding job)."""
    from strata.sources.tables import spread_small
    ch = word_chunks(spread_small(Ctx(spark, d).t.documents))
    ch = ch.withColumn("chunk_id", F.concat_ws(":", "doc_id", "chunk_ix"))
    e = V.embed_text(ch, "chunk_id", "document_text")
    return ch.join(e, "chunk_id").select("doc_id", "chunk_ix", "document_text", "embedding")


@register("pca_reduce")
def pca_reduce(spark, d):
    """Centred PCA to min(16, n_rows, width); query vectors (label centroids)
    are projected with the same fitted model, then searched."""
    valid, _ = valid_vectors(Ctx(spark, d))
    n = valid.count()
    k = max(1, min(16, n, V.vector_dim(valid)))
    red, model = V.pca_reduce(valid.select("vec_id", "embedding"), k)
    qv = V.project(label_queries(valid), model)
    return V.topk_cosine(red, qv)


@register("vector_topk_lsh")
def vector_topk_lsh(spark, d):
    valid, _ = valid_vectors(Ctx(spark, d))
    return V.lsh_topk(valid.select("vec_id", "embedding"), label_queries(valid))
