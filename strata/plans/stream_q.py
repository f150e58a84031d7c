"""Registered queries: streaming jobs, checked against their batch results."""

from __future__ import annotations

from strata.plans.access_q import _expensive, label_cache
from strata.plans.registry import Ctx, register
from strata.plans.sqlgen import ntok, units_ctes, with_ctes
from strata.session import scratch_path
from strata.streaming import jobs


def _land(ctx, n_files: int = 4) -> str:
    """Land the documents as several parquet files (arrival order = id range)."""
    path = scratch_path(ctx.spark, "landing")
    ctx.t.documents.repartitionByRange(n_files, "doc_id").write.parquet(path)
    return path


@register("stream_ingest_chunks", with_ctes(units_ctes(), "SELECT id, doc_id, level, chunk_ix, text, n_tokens FROM units"))
def stream_ingest_chunks(spark, d):
    """New files -> text units, exactly once: the job is run twice over the
    same checkpoint and the second run adds no rows."""
    ctx = Ctx(spark, d)
    landing = _land(ctx)
    out, ck = scratch_path(spark, "stream-units"), scratch_path(spark, "stream-units-ck")
    jobs.ingest_chunks(spark, landing, out, ck)
    jobs.ingest_chunks(spark, landing, out, ck)
    return spark.read.parquet(out).select("id", "doc_id", "level", "chunk_ix", "text", "n_tokens")


@register("stream_memo_enrichment", f"""
WITH k AS (SELECT doc_id, text, sha256(text || '|model=rule;temperature=0') AS key FROM documents),
cache AS (SELECT sha256(d.text || '|model=rule;temperature=0') AS key, min('cached:' || CAST(l.quality AS VARCHAR)) AS result
          FROM labels l JOIN documents d USING (doc_id) GROUP BY 1)
SELECT k.doc_id, coalesce(c.result, 'computed:' || CAST({ntok('k.text')} AS VARCHAR)) AS result
FROM k LEFT JOIN cache c USING (key)""")
def stream_memo_enrichment(spark, d):
    ctx = Ctx(spark, d)
    landing = _land(ctx)
    cache = scratch_path(spark, "memo-cache")
    label_cache(ctx).write.parquet(cache)
    out, ck = scratch_path(spark, "memo-out"), scratch_path(spark, "memo-ck")

    def enrich(df):
        return df.mapInPandas(_expensive, "doc_id long, result string")

    jobs.memo_enrichment(spark, landing, cache, out, ck, enrich)
    return spark.read.parquet(out).select("doc_id", "result")
