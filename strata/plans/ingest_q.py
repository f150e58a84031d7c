"""Registered queries: file scans, routing, conversion, skip-existing, sinks.

The file tree is derived from the ``documents`` table by Spark (one file per
document, extension by language), so every scan grows with the input.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.text import ext_of, html_to_text, stem_of
from strata.plans.html_sql import WRAP_SQL, html_sql
from strata.plans.registry import Ctx, register
from strata.plans.sqlgen import community_ctes, graph_ctes, q, report_ctes, with_ctes
from strata.session import scratch_path
from strata.sources import files as FS

# own fixture rule: file extension by document language
EXT_BY_LANG = (("en", ".txt"), ("fr", ".html"), ("de", ".docx"), ("es", ".xlsx"))


def _ext_expr():
    e = None
    for lang, ext in EXT_BY_LANG:
        e = F.when(F.col("lang") == lang, ext) if e is None else e.when(F.col("lang") == lang, ext)
    return e.otherwise(".bin")


EXT_SQL = "CASE lang " + " ".join(f"WHEN '{lg}' THEN '{x}'" for lg, x in EXT_BY_LANG) + " ELSE '.bin' END"
PATH_SQL = f"'raw/' || source || '/doc' || CAST(doc_id AS VARCHAR) || {EXT_SQL}"


def doc_paths(docs):
    return docs.select("doc_id", "lang", "text", F.concat(F.lit("raw/"), "source", F.lit("/doc"),
                                                          F.col("doc_id").cast("string"), _ext_expr()).alias("path"))


def virtual_files(docs):
    """binaryFile-shaped rows (path, modificationTime, length, content) built
    from the documents: txt as UTF-8, html wrapped in paragraphs, Office
    formats zipped by a per-batch Python helper."""
    p = doc_paths(docs)
    esc = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.concat(F.lit("<html><head><style>p{margin:0}</style></head><body><p>"),
                    F.replace(esc, F.lit("\n"), F.lit("</p><p>")), F.lit("</p><!-- end --></body></html>"))
    plain = p.select("path", F.when(F.col("path").endswith(".html"), F.encode(html, "UTF-8"))
                     .otherwise(F.encode("text", "UTF-8")).alias("content"))

    def office(batches):
        for pdf in batches:
            out = []
            for path, text in zip(pdf["path"], pdf["text"]):
                lines = (text or "").split("\n")
                out.append(FS.make_docx(lines) if path.endswith(".docx")
                           else FS.make_xlsx({"Sheet1": [ln.split(" ") for ln in lines]}))
            yield pd.DataFrame({"path": pdf["path"], "content": out})

    off = p.where(F.col("path").endswith(".docx") | F.col("path").endswith(".xlsx")) \
        .select("path", "text").mapInPandas(office, "path string, content binary")
    both = plain.where(~(F.col("path").endswith(".docx") | F.col("path").endswith(".xlsx"))).unionByName(off)
    return both.select("path", F.current_timestamp().alias("modificationTime"),
                       F.length("content").cast("long").alias("length"), "content")


@register("html_to_text", f"SELECT page_id, {html_sql('html')} AS text FROM pages")
def q_html_to_text(spark, d):
    from strata.sources.tables import spread_small
    return spread_small(Ctx(spark, d).t.pages).select("page_id", html_to_text(F.col("html")).alias("text"))


@register("path_parts", f"""
SELECT path, regexp_extract(path, '([^/]*?)(\\.[^./]*)?$', 1) AS stem, regexp_extract(path, '(\\.[^./]*)$', 1) AS ext,
       regexp_extract(path, '(\\.[^./]*)$', 1) IN ({', '.join(q(x) for x in FS.SUPPORTED_EXT)}) AS supported
FROM (SELECT {PATH_SQL} AS path FROM documents)""")
def path_parts(spark, d):
    p = doc_paths(Ctx(spark, d).t.documents)
    return p.select("path", stem_of(F.col("path")).alias("stem"), ext_of(F.col("path")).alias("ext"),
                    ext_of(F.col("path")).isin(*FS.SUPPORTED_EXT).alias("supported"))


@register("sorted_listing", f"""
SELECT path, row_number() OVER (ORDER BY path) AS row_id FROM (SELECT {PATH_SQL} AS path FROM documents)""")
def sorted_listing(spark, d):
    from strata.operators.windows import global_row_number
    p = doc_paths(Ctx(spark, d).t.documents).select("path")
    return global_row_number(p, [F.col("path")])


@register("head_preview", f"""
SELECT path FROM (SELECT {PATH_SQL} AS path FROM documents) ORDER BY path LIMIT 5""")
def head_preview(spark, d):
    return doc_paths(Ctx(spark, d).t.documents).select("path").orderBy("path").limit(5)


@register("ingest_skip_existing", f"""
SELECT regexp_extract(path, '([^/]*?)(\\.[^./]*)?$', 1) AS stem, min(path) AS path
FROM (SELECT {PATH_SQL} AS path FROM documents)
WHERE regexp_extract(path, '([^/]*?)(\\.[^./]*)?$', 1) NOT IN (SELECT 'doc' || CAST(doc_id AS VARCHAR) FROM labels)
GROUP BY 1""")
def ingest_skip_existing(spark, d):
    """Convert only files whose output (``<stem>.txt``) does not exist yet;
    within one stem the lowest path wins (deterministic, combinable min)."""
    ctx = Ctx(spark, d)
    existing = ctx.t.labels.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("stem"))
    return FS.skip_existing(doc_paths(ctx.t.documents).select("path"), existing)


@register("set_difference_new_files", f"""
SELECT path FROM (SELECT {PATH_SQL} AS path, doc_id FROM documents)
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def set_difference_new_files(spark, d):
    ctx = Ctx(spark, d)
    inputs = doc_paths(ctx.t.documents).select("doc_id", "path")
    return inputs.join(ctx.t.labels.select("doc_id"), "doc_id", "left_anti").select("path")


@register("anti_join_unprocessed", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_unprocessed(spark, d):
    t = Ctx(spark, d).t
    return t.documents.select("doc_id").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@register("scan_binary_route", f"""
SELECT path, regexp_extract(path, '(\\.[^./]*)$', 1) AS ext,
       CASE WHEN regexp_extract(path, '(\\.[^./]*)$', 1) IN ('.txt', '.html', '.docx', '.xlsx', '.pptx') THEN 'routed' ELSE 'quarantine' END AS status
FROM (SELECT {PATH_SQL} AS path FROM documents)""")
def scan_binary_route(spark, d):
    """Route the derived file tree by extension; unsupported -> quarantine."""
    vf = virtual_files(Ctx(spark, d).t.documents)
    routed, bad = FS.route(vf)
    return routed.select("path", "ext", F.lit("routed").alias("status")).unionByName(
        bad.select("path", "ext", F.lit("quarantine").alias("status")))


def _office_files(docs, ext: str, make):
    """One Office file per document, made of its lines by ``make``."""
    def build(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": [f"raw/{ext}/doc{i}.{ext}" for i in pdf["doc_id"]], "ext": f".{ext}",
                                "content": [make((t or "").split("\n")) for t in pdf["text"]]})
    return docs.select("doc_id", "text").mapInPandas(build, "path string, ext string, content binary")


@register("docx_to_text", """
SELECT 'raw/docx/doc' || CAST(doc_id AS VARCHAR) || '.docx' AS path, text, CAST(NULL AS VARCHAR) AS error
FROM documents""")
def docx_to_text(spark, d):
    """Each document line becomes one paragraph; parse back in order."""
    return FS.extract_office(_office_files(Ctx(spark, d).t.documents, "docx", FS.make_docx))


@register("xlsx_to_text", """
SELECT 'raw/xlsx/doc' || CAST(doc_id AS VARCHAR) || '.xlsx' AS path,
       'Sheet: Sheet1' || chr(10) || text || chr(10) AS text, CAST(NULL AS VARCHAR) AS error FROM documents""")
def xlsx_to_text(spark, d):
    """Each document line becomes one row of cells; parse back in row order."""
    return FS.extract_office(_office_files(
        Ctx(spark, d).t.documents, "xlsx", lambda lines: FS.make_xlsx({"Sheet1": [ln.split(" ") for ln in lines]})))


@register("pptx_to_text", """
SELECT 'raw/pptx/doc' || CAST(doc_id AS VARCHAR) || '.pptx' AS path, text || chr(10) AS text,
       CAST(NULL AS VARCHAR) AS error FROM documents""")
def pptx_to_text(spark, d):
    """Each document line becomes one slide shape; parse back in slide order."""
    return FS.extract_office(_office_files(
        Ctx(spark, d).t.documents, "pptx", lambda lines: FS.make_pptx([[ln] for ln in lines])))


@register("scan_text_docs", "SELECT doc_id, text FROM documents")
def scan_text_docs(spark, d):
    """Documents written as one text file each (partitioned by id), scanned
    back whole-file with a glob filter (the writer's final line separator
    removed); the id comes from the partition folder in the path."""
    from strata.sources.sinks import text_files
    path = text_files(Ctx(spark, d).t.documents, scratch_path(spark, "text-docs"), "doc_id", "text")
    t = FS.scan_text(spark, path, "*.txt")
    return t.select(F.regexp_extract("path", "doc_id=([0-9]+)", 1).cast("long").alias("doc_id"),
                    F.regexp_replace("text", "\n$", "").alias("text"))


@register("scan_csv_docs", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_docs(spark, d):
    from strata.schemas import INPUT_TABLES
    path = scratch_path(spark, "csv-docs")
    (Ctx(spark, d).t.documents.write.option("header", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return FS.scan_csv(spark, path, INPUT_TABLES["documents"])


@register("convert_files", f"""
SELECT {PATH_SQL} AS path, regexp_extract({PATH_SQL}, '([^/]*?)(\\.[^./]*)?$', 1) AS stem,
       CASE lang WHEN 'es' THEN 'Sheet: Sheet1' || chr(10) || text || chr(10)
                 WHEN 'fr' THEN {html_sql(WRAP_SQL)}
                 WHEN 'en' THEN regexp_replace(text, '^﻿', '')
                 ELSE text END AS text, CAST(NULL AS VARCHAR) AS error
FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')""")
def convert_files(spark, d):
    """The whole ingest job: derived files -> route -> convert (txt, html,
    docx, xlsx) -> (path, stem, text, error)."""
    vf = virtual_files(Ctx(spark, d).t.documents)
    routed, _ = FS.route(vf)
    return FS.convert(routed)


@register("table_read", with_ctes(graph_ctes(), "SELECT title, n_docs FROM entities WHERE level = 'admin'"))
def table_read(spark, d):
    """Emit the entity stage table partitioned by tier, read it back with its
    declared schema: the tier filter prunes whole partition folders."""
    from strata.schemas import ENTITIES
    from strata.sources.sinks import emit
    from strata.sources.tables import read_optional
    ctx = Ctx(spark, d)
    path = emit(ctx.g.entities, scratch_path(spark, "entities"), ("level",))
    from pyspark.sql import types as T
    schema = T.StructType(ENTITIES.fields + [T.StructField("n_docs", T.LongType()),
                                             T.StructField("n_descriptions", T.LongType())])
    df = read_optional(spark, path, schema)
    return df.where(F.col("level") == "admin").select("title", "n_docs")


@register("table_emit", with_ctes(graph_ctes() + community_ctes() + report_ctes(), """
SELECT 'text_units' AS "table", count(*) AS "rows" FROM units
UNION ALL SELECT 'entities', count(*) FROM entities
UNION ALL SELECT 'relationships', count(*) FROM ranked_relationships
UNION ALL SELECT 'nodes', count(*) FROM assign
UNION ALL SELECT 'community_reports', count(*) FROM reports"""))
def table_emit(spark, d):
    """Persist every stage table; returns (table, rows) read back."""
    from strata.sources.sinks import emit
    ctx = Ctx(spark, d)
    tables = {"text_units": ctx.g.units, "entities": ctx.g.entities, "relationships": ctx.g.ranked_relationships,
              "nodes": ctx.nodes, "community_reports": ctx.reports}
    root = scratch_path(spark, "emit")
    out = None
    for name, df in tables.items():
        p = emit(df, f"{root}/{name}", ("level",))
        c = spark.read.parquet(p).groupBy().count().select(F.lit(name).alias("table"), F.col("count").alias("rows"))
        out = c if out is None else out.unionByName(c)
    return out


@register("response_cache_scan", with_ctes(graph_ctes(), """
SELECT md5(concat_ws('|', u.text, 'rule-extractor', '0.0', '4000')) AS key, 'rule-extractor' AS model,
       CAST(r.n AS INTEGER) AS n_records
FROM (SELECT unit_id, count(*) AS n FROM (SELECT unit_id FROM unit_ents UNION ALL SELECT unit_id FROM unit_rels)
      GROUP BY unit_id) r JOIN units u ON u.id = r.unit_id"""))
def response_cache_scan(spark, d):
    """Memoised responses ``{result, input, parameters}`` written as JSON
    (one file group per extraction run) and read back with a declared schema;
    the content hash is recomputed from (input, parameters)."""
    from strata.operators.extract import format_records
    from strata.schemas import RESPONSE_CACHE
    ctx = Ctx(spark, d)
    recs = format_records(ctx.g.unit_entities, ctx.g.unit_relationships)
    rows = recs.join(ctx.g.units.select(F.col("id").alias("unit_id"), "text"), "unit_id").select(
        F.col("response").alias("result"), F.col("text").alias("input"),
        F.struct(F.lit("rule-extractor").alias("model"), F.lit(0.0).alias("temperature"),
                 F.lit(4000).alias("max_tokens")).alias("parameters"))
    path = scratch_path(spark, "response-cache")
    rows.write.option("compression", "gzip").json(path)
    back = spark.read.schema(RESPONSE_CACHE).json(path)
    key = F.md5(F.concat_ws("|", "input", "parameters.model", F.col("parameters.temperature").cast("string"),
                            F.col("parameters.max_tokens").cast("string")))
    n_records = F.size(F.split(F.replace("result", F.lit(C.COMPLETE), F.lit("")), C.RECORD_DELIM))
    return back.select(key.alias("key"), F.col("parameters.model").alias("model"), n_records.alias("n_records"))


LOG_RE = "perf - llm\\.chat ([a-z]+) \"Process\" took ([0-9.]+)\\. input_tokens=([0-9]+), output_tokens=([0-9]+)"


@register("run_log_metrics", f"""
SELECT kind, count(*) AS n_calls, round(sum(seconds), 6) AS total_seconds, round(max(seconds), 6) AS max_seconds,
       CAST(sum(input_tokens) AS BIGINT) AS input_tokens
FROM (SELECT regexp_extract(line, {q(LOG_RE)}, 1) AS kind,
             CAST(regexp_extract(line, {q(LOG_RE)}, 2) AS DOUBLE) AS seconds,
             CAST(regexp_extract(line, {q(LOG_RE)}, 3) AS BIGINT) AS input_tokens
      FROM (SELECT 'perf - llm.chat ' || event_type || ' "Process" took ' || CAST(value AS VARCHAR)
                   || '. input_tokens=' || json_extract_string(props, '$.k') || ', output_tokens='
                   || CAST(user_id AS VARCHAR) AS line FROM events))
GROUP BY kind""")
def run_log_metrics(spark, d):
    """Log lines (one per event) written as text, scanned back and parsed
    with one regex: calls, seconds and tokens per kind."""
    e = Ctx(spark, d).t.events
    lines = e.select(F.concat(F.lit("perf - llm.chat "), "event_type", F.lit(' "Process" took '),
                              F.col("value").cast("string"), F.lit(". input_tokens="),
                              F.get_json_object("props", "$.k"), F.lit(", output_tokens="),
                              F.col("user_id").cast("string")).alias("value"))
    path = scratch_path(spark, "run-log")
    lines.write.text(path)
    t = spark.read.text(path)
    p = t.select(F.regexp_extract("value", LOG_RE, 1).alias("kind"),
                 F.regexp_extract("value", LOG_RE, 2).cast("double").alias("seconds"),
                 F.regexp_extract("value", LOG_RE, 3).cast("long").alias("input_tokens"))
    return p.groupBy("kind").agg(F.count(F.lit(1)).alias("n_calls"), F.round(F.sum("seconds"), 6).alias("total_seconds"),
                                 F.round(F.max("seconds"), 6).alias("max_seconds"),
                                 F.sum("input_tokens").alias("input_tokens"))
