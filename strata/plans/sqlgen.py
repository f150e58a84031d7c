"""ANSI/DuckDB SQL for the oracle side of every registered query.

The CTEs restate each stage's rule in plain SQL, independently of the Spark
code path (windows where Spark uses array functions, ``lead`` where Spark
zips arrays, unrolled rounds where Spark loops), so a match is a real check.
"""

from __future__ import annotations

from strata import config as C


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS = q(C.WS_TOKEN_RE)
STRIP = q("^[ \t\n\r\f]+|[ \t\n\r\f]+$")


def tier_sql(col: str = "doc_id") -> str:
    return (f"CASE (({col} % 3) + 3) % 3 WHEN 0 THEN 'general' WHEN 1 THEN 'level_q' "
            f"ELSE 'admin' END")


def type_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} LIKE '{p}' THEN '{t}'" for p, t in C.TYPE_RULES)
    return f"CASE {whens} ELSE '{C.DEFAULT_TYPE}' END"


def tier_types_sql(level: str = "level") -> str:
    cases = " ".join(f"WHEN '{tier}' THEN [{', '.join(q(t) for t in types)}]"
                     for tier, types in C.TIER_TYPES.items())
    return f"CASE {level} {cases} ELSE [] END"


def ntok(x: str) -> str:
    return f"len(regexp_extract_all({x}, {WS}))"


def units_ctes(size: int = C.UNIT_SIZE, overlap: int = C.UNIT_OVERLAP) -> list[str]:
    stride = size - overlap
    return [
        f"docs AS (SELECT doc_id, text, {tier_sql()} AS level FROM documents)",
        f"doc_toks AS (SELECT doc_id, level, regexp_extract_all(text, {WS}) AS toks FROM docs)",
        f"""units AS (
  SELECT md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(chunk_ix AS VARCHAR))) AS id,
         doc_id, level, chunk_ix, text, n_tokens FROM (
    SELECT doc_id, level, CAST(s // {stride} AS INTEGER) AS chunk_ix,
           array_to_string(toks[s + 1 : s + {size}], ' ') AS text,
           CAST(least({size}, len(toks) - s) AS INTEGER) AS n_tokens
    FROM (SELECT doc_id, level, toks, unnest(range(0, greatest(len(toks), 1), {stride})) AS s FROM doc_toks))
  WHERE n_tokens > 0)""",
    ]


def summary_cte(name: str, src: str, keys: list[str], cap: int = C.SUMMARY_CAP) -> str:
    k = ", ".join(keys)
    return f"""{name} AS (
  SELECT {k}, string_agg(description, ' ' ORDER BY rn) AS summary FROM (
    SELECT {k}, description, rn,
           sum({ntok('description')}) OVER (PARTITION BY {k} ORDER BY description
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
    FROM (SELECT {k}, description, row_number() OVER (PARTITION BY {k} ORDER BY description) AS rn
          FROM (SELECT DISTINCT {k}, description FROM {src}
                WHERE description IS NOT NULL AND description <> '')))
  WHERE cum <= {cap} OR rn = 1 GROUP BY {k})"""


def graph_ctes() -> list[str]:
    sent_re = q(C.SENTENCE_RE)
    return units_ctes() + [
        f"""unit_sents AS (
  SELECT id, doc_id, level, unnest(sents) AS s, generate_subscripts(sents, 1) - 1 AS sent_ix
  FROM (SELECT id, doc_id, level, regexp_extract_all(text, {sent_re}) AS sents FROM units))""",
        f"""sent_words AS (
  SELECT id, doc_id, level, sent_ix, sentence, unnest(ws) AS w, generate_subscripts(ws, 1) AS w_ix
  FROM (SELECT id, doc_id, level, sent_ix, regexp_replace(s, {STRIP}, '', 'g') AS sentence,
               list_filter(regexp_extract_all(s, {q(C.LETTER_RUN_RE)}),
                           lambda w: regexp_full_match(w, {q(C.ENTITY_WORD_RE[1:-1])})) AS ws
        FROM unit_sents))""",
        f"""mentions AS (
  SELECT id AS unit_id, doc_id, level, title, type, sent_ix, w_ix, sentence,
         row_number() OVER (PARTITION BY id ORDER BY sent_ix, w_ix) AS pos
  FROM (SELECT *, upper(replace(w, 'ß', 'ss')) AS title, {type_sql("upper(replace(w, 'ß', 'ss'))")} AS type FROM sent_words)
  WHERE list_contains({tier_types_sql()}, type))""",
        """unit_ents AS (
  SELECT level, doc_id, unit_id, title, min(type) AS type, arg_min(sentence, pos) AS description
  FROM mentions GROUP BY level, doc_id, unit_id, title)""",
        """pairs AS (
  SELECT level, doc_id, unit_id, pos, title AS a_t, sent_ix AS a_s, sentence AS a_x,
         lead(title) OVER w AS b_t, lead(sent_ix) OVER w AS b_s, lead(sentence) OVER w AS b_x
  FROM mentions WINDOW w AS (PARTITION BY unit_id ORDER BY pos))""",
        """unit_rels AS (
  SELECT level, doc_id, unit_id, least(a_t, b_t) AS source, greatest(a_t, b_t) AS target,
         count(*) AS strength,
         arg_min(CASE WHEN a_s = b_s THEN a_x ELSE concat_ws(' ', a_x, b_x) END, pos) AS description
  FROM pairs WHERE b_t IS NOT NULL AND a_t <> b_t
  GROUP BY level, doc_id, unit_id, least(a_t, b_t), greatest(a_t, b_t))""",
        f"""qualified AS (
  SELECT level, title, count(DISTINCT doc_id) AS n_docs FROM unit_ents
  GROUP BY level, title)""",
        """q_unit_ents AS (
  SELECT u.* FROM unit_ents u JOIN qualified q ON u.level = q.level AND u.title = q.title)""",
        summary_cte("ent_summary", "q_unit_ents", ["level", "title"]),
        """entities AS (
  SELECT q.level, md5(concat_ws('|', q.level, q.title)) AS id, q.title, t.type,
         coalesce(s.summary, '') AS description, q.n_docs, t.n_units, t.n_descriptions
  FROM qualified q
  JOIN (SELECT level, title, min(type) AS type, count(DISTINCT unit_id) AS n_units,
               count(DISTINCT description) AS n_descriptions FROM q_unit_ents GROUP BY level, title) t
    ON q.level = t.level AND q.title = t.title
  LEFT JOIN ent_summary s ON q.level = s.level AND q.title = s.title)""",
        """pair_rows AS (
  SELECT r.* FROM unit_rels r
  JOIN qualified a ON r.level = a.level AND r.source = a.title
  JOIN qualified b ON r.level = b.level AND r.target = b.title)""",
        summary_cte("rel_summary", "pair_rows", ["level", "source", "target"]),
        """relationships AS (
  SELECT r.level, md5(concat_ws('|', r.level, r.source, r.target)) AS id, r.source, r.target,
         coalesce(s.summary, '') AS description, r.weight, r.n_units
  FROM (SELECT level, source, target, CAST(sum(strength) AS DOUBLE) AS weight,
               count(DISTINCT unit_id) AS n_units FROM pair_rows GROUP BY level, source, target) r
  LEFT JOIN rel_summary s ON r.level = s.level AND r.source = s.source AND r.target = s.target)""",
        """degrees AS (
  SELECT e.level, e.title, CAST(coalesce(d.degree, 0) AS BIGINT) AS degree FROM entities e
  LEFT JOIN (SELECT level, title, count(*) AS degree FROM (
      SELECT level, source AS title FROM relationships UNION ALL SELECT level, target FROM relationships)
    GROUP BY level, title) d ON e.level = d.level AND e.title = d.title)""",
        """ranked_relationships AS (
  SELECT r.*, CAST(ds.degree + dt.degree AS BIGINT) AS rank FROM relationships r
  JOIN degrees ds ON r.level = ds.level AND r.source = ds.title
  JOIN degrees dt ON r.level = dt.level AND r.target = dt.title)""",
    ]


def _contraction(name: str, members: str) -> str:
    """Rounds of contraction as a recursion over the labels of ``members``(node, grp);
    entities are keyed by tier and title in one string, edges are summed anew each round."""
    return f"""{name}e AS MATERIALIZED (SELECT *, sum(w) OVER (PARTITION BY grp) AS m FROM (
  SELECT a.grp, r.c, r.d, sum(r.w) AS w FROM keyed r JOIN {members} a ON a.node = r.c
  JOIN {members} b ON b.node = r.d WHERE a.grp = b.grp GROUP BY ALL)),
{name}k AS MATERIALIZED (SELECT node, sum(w) AS k FROM (SELECT unnest([c, d]) AS node, w FROM {name}e) GROUP BY ALL),
{name} AS (
  SELECT 0 AS i, node, node AS label FROM {members}
  UNION ALL (
  WITH ce AS (SELECT least(a.label, b.label) AS c, greatest(a.label, b.label) AS d, sum(e.w) AS w, max(e.m) AS m
    FROM {name}e e JOIN {name} a ON a.node = e.c JOIN {name} b ON b.node = e.d WHERE a.label <> b.label GROUP BY ALL),
  ck AS MATERIALIZED (SELECT n.label AS node, sum(k.k) AS k FROM {name}k k JOIN {name} n USING (node) GROUP BY ALL),
  g AS MATERIALIZED (SELECT c, d, 2 * m * w - x.k * y.k AS gain FROM ce JOIN ck x ON x.node = c JOIN ck y ON y.node = d
    WHERE 2 * m * w > x.k * y.k),
  best AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, c, d) AS r
    FROM (SELECT *, unnest([c, d]) AS node FROM g)) WHERE r = 1),
  centre AS (SELECT unnest([c, d]) AS node, c AS root FROM best GROUP BY c, d HAVING count(*) = 2),
  step AS MATERIALIZED (SELECT b.node, t.root FROM best b JOIN centre t ON t.node = CASE WHEN b.node = b.c THEN b.d ELSE b.c END)
  SELECT n.i + 1, n.node, coalesce(s.root, n.label) FROM {name} n LEFT JOIN step s ON s.node = n.label
  WHERE EXISTS (SELECT 1 FROM step)))"""


#: contractions of the frontier that the SQL spells out; the given tables at sf0.01 need fewer
SQL_PASSES = 5


def community_ctes(passes: int = SQL_PASSES, max_size: int = C.MAX_CLUSTER_SIZE) -> list[str]:
    out = ["""keyed AS MATERIALIZED (SELECT level || '|' || least(source, target) AS c, level || '|' || greatest(source, target) AS d,
  weight AS w FROM relationships WHERE source <> target)""",
           "m0 AS MATERIALIZED (SELECT level || '|' || title AS node, level AS grp, 0 AS base FROM entities)"]
    for d in range(passes):
        x, rounds = f"x{d}", f"(SELECT max(i) FROM x{d})"
        out += [
            _contraction(x, f"m{d}"),
            f"p{d} AS (SELECT b.i, b.label, count(DISTINCT a.label) AS k FROM {x} a JOIN {x} b ON b.node = a.node AND b.i = a.i + 1 GROUP BY ALL)",
            f"t{d} AS (SELECT m.grp, count(DISTINCT x.label) AS k FROM {x} x JOIN m{d} m USING (node) WHERE x.i = {rounds} GROUP BY m.grp)",
            f"""ch{d} AS MATERIALIZED (SELECT y.node, y.label, y.n, m.grp, m.base, row_number() OVER w - 1 AS j, lag(y.n) OVER w AS above,
    lag(y.label) OVER w AS over_label FROM (
  SELECT x.node, x.i, x.label, count(*) OVER (PARTITION BY x.i, x.label) AS n FROM {x} x
  WHERE x.i >= 1{f" OR {rounds} = 0" if not d else ""}) y
  JOIN m{d} m USING (node) JOIN t{d} t ON t.grp = m.grp
  LEFT JOIN {x} u ON u.node = y.node AND u.i = y.i + 1 LEFT JOIN p{d} p ON p.i = u.i AND p.label = u.label
  WHERE CASE WHEN y.i = {rounds} THEN m.base = 0 OR t.k > 1 ELSE p.k > 1 END
  WINDOW w AS (PARTITION BY y.node ORDER BY y.i DESC))""",
            f"""c{d} AS MATERIALIZED (SELECT node, n, string_split(node, '|')[1] AS level, substr(node, instr(node, '|') + 1) AS title,
  base + j AS cluster_level, md5(concat_ws('|', string_split(node, '|')[1], base + j, substr(label, instr(label, '|') + 1))) AS community,
  CASE WHEN j > 0 THEN md5(concat_ws('|', string_split(node, '|')[1], base + j - 1, substr(over_label, instr(over_label, '|') + 1)))
       WHEN base > 0 THEN grp END AS parent,
  j = max(j) OVER (PARTITION BY node) AS finest FROM ch{d} WHERE j = 0 OR above > {max_size})""",
            f"m{d + 1} AS MATERIALIZED (SELECT node, community AS grp, cluster_level + 1 AS base FROM c{d} WHERE finest AND n > {max_size})"]
    union = " UNION ALL ".join(f"SELECT level, title, CAST(cluster_level AS INTEGER) AS cluster_level, community, parent FROM c{d}" for d in range(passes))
    out.append(f"assign AS MATERIALIZED ({union})")
    out.append("""nodes AS (SELECT a.level, a.title, CAST(a.cluster_level AS INTEGER) AS cluster_level,
  a.community, a.parent, d.degree FROM assign a JOIN degrees d ON a.level = d.level AND a.title = d.title)""")
    return out


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


def report_ctes(max_level: int = C.QUERY_COMMUNITY_LEVEL) -> list[str]:
    """Mirror of the extractive community reports and the global context."""
    ck = "level, cluster_level, community"
    return [
        """ie AS (SELECT r.*, s.cluster_level, s.community FROM ranked_relationships r
  JOIN assign s ON r.level = s.level AND r.source = s.title
  JOIN assign t ON r.level = t.level AND r.target = t.title AND s.cluster_level = t.cluster_level
  WHERE s.community = t.community)""",
        f"c_size AS (SELECT {ck}, count(*) AS size FROM assign GROUP BY {ck})",
        f"c_edges AS (SELECT {ck}, count(*) AS n_edges FROM ie GROUP BY {ck})",
        f"""c_units AS (SELECT x.level, x.cluster_level, x.community, count(DISTINCT q.unit_id) AS n_units
  FROM assign x JOIN q_unit_ents q ON x.level = q.level AND x.title = q.title GROUP BY x.level, x.cluster_level, x.community)""",
        f"""c_name AS (SELECT {ck}, string_agg(title, ' & ' ORDER BY r) AS name FROM (
  SELECT a.*, row_number() OVER (PARTITION BY a.level, a.cluster_level, a.community
                                 ORDER BY d.degree DESC, a.title) AS r
  FROM assign a JOIN degrees d ON a.level = d.level AND a.title = d.title) WHERE r <= 2 GROUP BY {ck})""",
        f"""c_find AS (SELECT {ck}, count(*) AS n_findings,
  string_agg(concat_ws(': ', concat_ws(' - ', source, target), description), chr(10) ORDER BY r) AS fstr FROM (
  SELECT ie.*, row_number() OVER (PARTITION BY level, cluster_level, community ORDER BY rank DESC, id) AS r FROM ie)
  WHERE r <= 5 GROUP BY {ck})""",
        f"""reports AS (SELECT s.level, s.cluster_level, s.community, s.size,
  coalesce(e.n_edges, 0) AS n_edges, coalesce(u.n_units, 0) AS n_units, n.name,
  coalesce(f.n_findings, 0) AS n_findings,
  round(least(10.0, 10.0 * coalesce(e.n_edges, 0) / greatest(1.0, s.size * (s.size - 1) / 2.0)), 2) AS rating,
  'Community of ' || n.name AS title,
  'Community of ' || CAST(s.size AS VARCHAR) || ' entities around ' || n.name || '.' AS summary,
  CAST(coalesce(e.n_edges, 0) AS VARCHAR) || ' internal relationships among ' || CAST(s.size AS VARCHAR) || ' entities.'
    AS rating_explanation,
  concat_ws(chr(10), '# Community of ' || n.name,
            'Community of ' || CAST(s.size AS VARCHAR) || ' entities around ' || n.name || '.',
            coalesce(f.fstr, '')) AS full_content
  FROM c_size s LEFT JOIN c_edges e USING ({ck}) LEFT JOIN c_units u USING ({ck})
  JOIN c_name n USING ({ck}) LEFT JOIN c_find f USING ({ck}))""",
        f"""rep_fin AS (SELECT DISTINCT {ck} FROM (
  SELECT *, row_number() OVER (PARTITION BY level, title ORDER BY cluster_level DESC) AS r
  FROM assign WHERE cluster_level <= {max_level}) WHERE r = 1)""",
        f"rep_lvl AS (SELECT r.* FROM reports r JOIN rep_fin USING ({ck}))",
        f"""gctx AS (SELECT *, ntok_row AS tokens FROM (
  SELECT x.*, {ntok('x.row')} AS ntok_row FROM (
    SELECT r.*, md5(r.community || {q(C.SHUFFLE_SEED)}) AS shuffle_key,
           concat_ws('|', r.community, r.title, printf('%.6f', r.occurrence_weight), r.full_content,
                     printf('%.2f', r.rating)) AS row
    FROM (SELECT r.*, round(CASE WHEN mx.mx > 0 THEN r.n_units / mx.mx ELSE 0.0 END, 6) AS occurrence_weight
          FROM rep_lvl r JOIN (SELECT level, max(n_units) AS mx FROM rep_lvl GROUP BY level) mx USING (level)
          WHERE r.rating >= {C.MIN_COMMUNITY_RANK}) r) x))""",
    ]


def words_sql(x: str) -> str:
    from strata.operators.vectors import EMBED_WORD_RE
    return f"list_distinct(regexp_extract_all(lower({x}), {q(EMBED_WORD_RE)}))"


def search_ctes() -> list[str]:
    return [
        f"""qwords AS (SELECT item_id AS question_id, unnest({words_sql('text')}) AS w FROM benchmark)""",
        f"""rwords AS (SELECT level, cluster_level, community, unnest({words_sql('row')}) AS w FROM gctx)""",
        """impact AS (SELECT level, w, CAST(floor(1000 * ln((n + 1) / df)) AS BIGINT) AS impact
  FROM (SELECT level, w, count(*) AS df FROM rwords GROUP BY level, w)
  JOIN (SELECT level, count(*) AS n FROM gctx GROUP BY level) USING (level))""",
        """qtotal AS (SELECT question_id, level, sum(impact) AS total FROM qwords JOIN impact USING (w) GROUP BY question_id, level)""",
        """mscore AS (SELECT h.*, CAST(floor(100 * h.impact / t.total) AS INTEGER) AS score FROM (
  SELECT question_id, level, cluster_level, community, sum(impact) AS impact
  FROM qwords JOIN impact USING (w) JOIN rwords USING (level, w) WHERE impact > 0
  GROUP BY question_id, level, cluster_level, community) h JOIN qtotal t USING (question_id, level))""",
        f"""greduce AS (SELECT * FROM (
  SELECT m.*, g.tokens, row_number() OVER w AS rn, sum(g.tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tokens
  FROM mscore m JOIN gctx g USING (level, cluster_level, community)
  WINDOW w AS (PARTITION BY m.question_id, m.level ORDER BY m.impact DESC, m.community))
  WHERE cum_tokens <= {C.SEARCH_BUDGET})""",
        """answers AS (SELECT g.question_id, g.level, r.title AS answer FROM greduce g
  JOIN reports r USING (level, cluster_level, community) WHERE g.rn = 1)""",
    ]


def clearance_values(alias: str = "clearance") -> str:
    rows = ", ".join(f"('{u}', '{t}')" for u, ts in C.CLEARANCE.items() for t in ts)
    return f"(VALUES {rows}) AS {alias}(user_level, level)"


def embed_sql(src: str, id_expr: str, text_expr: str, name: str) -> str:
    """Hashed term frequencies (sparse) and their norms, as two CTEs."""
    from strata.operators.vectors import EMBED_DIM, EMBED_WORD_RE
    return f"""{name}_t AS (
  SELECT id, (('0x' || substr(md5(w), 1, 8))::BIGINT % {EMBED_DIM}) AS bucket, CAST(count(*) AS DOUBLE) AS tf
  FROM (SELECT {id_expr} AS id, unnest(regexp_extract_all(lower({text_expr}), {q(EMBED_WORD_RE)})) AS w FROM {src})
  GROUP BY id, bucket),
{name}_n AS (SELECT id, sqrt(sum(tf * tf)) AS n FROM {name}_t GROUP BY id)"""


def entity_match_ctes(k: int = C.TOP_K_ENTITIES) -> list[str]:
    """ematch(question_id, level, title, score, rk): per (question, tier)
    the k nearest entities, by a sparse dot product on shared buckets."""
    return [
        embed_sql("entities", "('0x' || substr(id, 1, 15))::BIGINT", "'\"' || title || '\":' || description", "ev"),
        embed_sql("benchmark", "item_id", "text", "qv"),
        "ekey AS (SELECT ('0x' || substr(id, 1, 15))::BIGINT AS ent_key, level, title FROM entities)",
        """sc AS (SELECT qn.id AS query_id, k.level, k.title, en.id AS ent_key,
         round(coalesce(d.dot, 0) / (qn.n * en.n) + 1.0, 6) AS score
  FROM qv_n qn CROSS JOIN ev_n en JOIN ekey k ON k.ent_key = en.id
  LEFT JOIN (SELECT a.id AS qid, b.id AS eid, sum(a.tf * b.tf) AS dot FROM qv_t a JOIN ev_t b USING (bucket)
             GROUP BY a.id, b.id) d ON d.qid = qn.id AND d.eid = en.id)""",
        f"""ematch AS (SELECT query_id AS question_id, level, title, score, CAST(rk AS INTEGER) AS rk FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, level ORDER BY score DESC, ent_key) AS rk FROM sc)
  WHERE rk <= {k})""",
    ]


def local_ctes() -> list[str]:
    """Local search sections (mirror of strata.operators.search.local_context)."""
    b_rep = int(C.SEARCH_BUDGET * C.COMMUNITY_PROP)
    b_unit = int(C.SEARCH_BUDGET * C.TEXT_UNIT_PROP)
    b_rest = int(C.SEARCH_BUDGET * (1 - C.COMMUNITY_PROP - C.TEXT_UNIT_PROP))
    return [
        """touch AS (SELECT m.question_id, r.level, r.id, r.source, r.target, r.rank, r.weight, count(*) AS ends
  FROM ranked_relationships r JOIN ematch m ON r.level = m.level AND (r.source = m.title OR r.target = m.title)
  GROUP BY m.question_id, r.level, r.id, r.source, r.target, r.rank, r.weight)""",
        f"""lrels AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id, level
  ORDER BY ends DESC, rank DESC, id) AS rn FROM touch) WHERE rn <= {C.TOP_K_RELATIONSHIPS})""",
        """lunits AS (SELECT u.question_id, u.level, u.unit_id, u.entity_rk, coalesce(r.n_rels, 0) AS n_rels FROM
  (SELECT m.question_id, q.level, q.unit_id, min(m.rk) AS entity_rk FROM q_unit_ents q
   JOIN ematch m ON q.level = m.level AND q.title = m.title GROUP BY m.question_id, q.level, q.unit_id) u
  LEFT JOIN (SELECT a.question_id, p.level, p.unit_id, count(*) AS n_rels FROM pair_rows p
             JOIN ematch a ON p.level = a.level AND p.source = a.title
             JOIN ematch b ON p.level = b.level AND p.target = b.title AND a.question_id = b.question_id
             GROUP BY a.question_id, p.level, p.unit_id) r
  ON u.question_id = r.question_id AND u.level = r.level AND u.unit_id = r.unit_id)""",
        f"""fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level, title ORDER BY cluster_level DESC) AS r
  FROM assign WHERE cluster_level <= {C.QUERY_COMMUNITY_LEVEL}) WHERE r = 1)""",
        f"""lrows AS (
  SELECT m.question_id, m.level, 'entity' AS section, m.title AS item, CAST(m.rk AS BIGINT) AS ord1, CAST(0 AS BIGINT) AS ord2,
         CAST({ntok("concat_ws(',', m.title, CAST(d.degree AS VARCHAR))")} AS BIGINT) AS tokens, {b_rest} AS budget
  FROM ematch m JOIN degrees d ON m.level = d.level AND m.title = d.title
  UNION ALL
  SELECT question_id, level, 'relationship', id, CAST(rn AS BIGINT), CAST(0 AS BIGINT),
         CAST({ntok("concat_ws(',', source, target, CAST(weight AS VARCHAR))")} AS BIGINT), {b_rest} FROM lrels
  UNION ALL
  SELECT c.question_id, c.level, 'report', c.community, CAST(-c.n_matched AS BIGINT),
         CAST(round(-r.rating * 100) AS BIGINT), CAST({ntok('r.full_content')} AS BIGINT), {b_rep}
  FROM (SELECT m.question_id, f.level, f.cluster_level, f.community, count(*) AS n_matched FROM ematch m
        JOIN fin f ON m.level = f.level AND m.title = f.title
        GROUP BY m.question_id, f.level, f.cluster_level, f.community) c
  JOIN reports r ON c.level = r.level AND c.cluster_level = r.cluster_level AND c.community = r.community
  UNION ALL
  SELECT l.question_id, l.level, 'unit', l.unit_id, CAST(l.entity_rk AS BIGINT), CAST(-l.n_rels AS BIGINT),
         CAST(u.n_tokens AS BIGINT), {b_unit}
  FROM lunits l JOIN units u ON u.id = l.unit_id)""",
        f"""lctx AS (SELECT * FROM (
  SELECT *, row_number() OVER w AS rn, sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tokens
  FROM lrows WINDOW w AS (PARTITION BY question_id, level, section ORDER BY ord1, ord2, item))
  WHERE rn <= {C.SEARCH_BUDGET} AND cum_tokens <= budget)""",
    ]
