from strata.operators.reports import grounding_refs, parse_report_json


def test_report_json_quarantine(spark):
    good = '{"title":"T","summary":"S","rating":7.5,"rating_explanation":"E","findings":[{"summary":"a","explanation":"b"}]}'
    rows = [("c1", good), ("c2", good[:40]), ("c3", good.replace("7.5", "11"))]
    df = spark.createDataFrame(rows, "community string, json string")
    got = {r.community: r for r in parse_report_json(df).collect()}
    assert got["c1"].valid and got["c1"].rating == 7.5 and got["c1"].findings[0].explanation == "b"
    assert not got["c2"].valid            # truncated JSON
    assert not got["c3"].valid            # rating out of range


def test_grounding_flags(spark):
    rows = [("r1", "x [Data: Entities (a1, a2)] y"), ("r2", "[Data: Entities (a1, a2, a3, a4, a5, a6)]"),
            ("r3", "[Data: Entities (zz)]")]
    df = spark.createDataFrame(rows, "rid string, text string")
    known = spark.createDataFrame([(f"a{i}",) for i in range(1, 7)], "sid string")
    got = {r.rid: r for r in grounding_refs(df, "text", known, "rid").collect()}
    assert (got["r1"].n_ids, got["r1"].too_many, got["r1"].n_missing) == (2, False, 0)
    assert got["r2"].too_many
    assert got["r3"].n_missing == 1


def test_shown_refs_cut_the_text_only(spark):
    from strata.operators.reports import missing_refs, shown_refs
    members = spark.createDataFrame([("a", f"e{i}") for i in range(7)] + [("b", f"e{i}") for i in range(5)], "community string, id string")
    got = {r.community: r.ref for r in shown_refs(members, ["community"], "id").collect()}
    assert got == {"a": "[Data: Entities (e0, e1, e2, e3, e4, +more)]", "b": "[Data: Entities (e0, e1, e2, e3, e4)]"}
    known = spark.createDataFrame([(f"e{i}",) for i in range(6)], "id string")
    assert [(r.community, r.id) for r in missing_refs(members, "id", known).collect()] == [("a", "e6")]   # past the shown ones


def _rolled(levels, budget):
    """{(cluster_level, community): [(child, as_report, tokens)]} by dictionaries; ``levels`` holds, for
    each cluster level, {community: (parent, own, kept, report)}."""
    context, out = {}, {}
    for depth in range(len(levels) - 1, -1, -1):
        for c, (_, own, kept, _) in levels[depth].items():
            below = levels[depth + 1] if depth + 1 < len(levels) else {}
            kids = sorted((k for k, v in below.items() if v[0] == c), key=lambda k: (-context[k], k))
            if own <= budget or not kids:
                context[c] = kept
                continue
            for n in range(len(kids) + 1):
                part = [(k, i < n, below[k][3] if i < n else context[k]) for i, k in enumerate(kids)]
                if sum(t for _, _, t in part) <= budget:
                    break
            else:
                part, used = [], 0
                for k in kids:
                    used += below[k][3]
                    if used <= budget:
                        part.append((k, True, below[k][3]))
            out[depth, c] = part
            context[c] = sum(t for _, _, t in part)
    return out


def test_rollup_rebuilds_contexts_from_the_bottom(spark):
    from pyspark.sql import functions as F

    from strata.functions.text import token_count
    from strata.operators.communities import cluster_graph
    from strata.operators.reports import community_context, context_rollup, edge_csv, touching_edges
    import random
    r = random.Random(3)
    edges = {tuple(sorted((f"N{i:03d}", f"N{(i + r.randrange(1, 6)) % 150:03d}"))) for i in range(150) for _ in range(3)}
    rels = spark.createDataFrame([("t", f"r{i}", a, b, 1.0, "word " * r.randrange(1, 30), i % 7) for i, (a, b) in enumerate(sorted(edges))],
                                 "level string, id string, source string, target string, weight double, description string, rank long")
    ents = spark.createDataFrame([("t", f"N{i:03d}") for i in range(150)], "level string, title string")
    assign = cluster_graph(ents, rels)
    text = F.expr("repeat('w ', 5 + cast(conv(substr(community, 1, 2), 16, 10) as int) % 60)")
    reports = assign.select("level", "cluster_level", "community").distinct().withColumn("full_content", text)
    budget = 400
    touch = touching_edges(assign, rels)
    key = ["level", "cluster_level", "community"]
    own = {r_.community: r_.n for r_ in touch.withColumn("t", token_count(edge_csv(touch))).groupBy(*key).agg(F.sum("t").alias("n")).collect()}
    kept = {r_.community: r_.n for r_ in community_context(assign, rels, budget).groupBy(*key).agg(F.max("cum_tokens").alias("n")).collect()}
    rep = {r_.community: len(r_.full_content.split()) for r_ in reports.collect()}
    levels = {}
    for a in assign.collect():
        levels.setdefault(a.cluster_level, {})[a.community] = (a.parent, own.get(a.community, 0), kept.get(a.community, 0), rep[a.community])
    want = _rolled([levels[k] for k in sorted(levels)], budget)
    got = {}
    for row in context_rollup(assign, rels, reports, budget).orderBy("rn").collect():
        assert row.context_tokens <= budget
        got.setdefault((row.cluster_level, row.community), []).append((row.child, row.as_report, row.tokens))
    assert got == {k: v for k, v in want.items() if v} and len(got) > 3
    assert len({lvl for lvl, _ in got}) > 1


def test_edges_meet_communities_once(spark):
    from strata.operators.reports import internal_edges, touching_edges
    # A, B: same community on level 0, split on level 1; C alone; X has no community
    at = [("A", 0, "p"), ("B", 0, "p"), ("C", 0, "q"), ("A", 1, "p1"), ("B", 1, "p2"), ("D", 0, None), ("E", 0, None)]
    assign = spark.createDataFrame([("admin", t, c, g) for t, c, g in at], "level string, title string, cluster_level int, community string")
    ends = [("e1", "A", "B"), ("e2", "A", "C"), ("e3", "X", "C"), ("e4", "D", "E"), ("e1", "A", "B"), ("e5", "X", "Y"), ("e6", None, "C")]
    rels = spark.createDataFrame([("admin", i, a, b, 1) for i, a, b in ends], "level string, id string, source string, target string, rank int")
    rows = lambda df: sorted((r.id, r.cluster_level, str(r.community), r.source, r.target, r["rank"]) for r in df.collect())
    inner, touch = internal_edges(assign, rels), touching_edges(assign, rels)
    assert rows(inner) == [("e1", 0, "p", "A", "B", 1)] * 2
    assert [x[:3] for x in rows(touch)] == [("e1", 0, "p"), ("e1", 1, "p1"), ("e1", 1, "p2"), ("e2", 0, "p"), ("e2", 0, "q"),
                                            ("e2", 1, "p1"), ("e3", 0, "q"), ("e4", 0, "None"), ("e6", 0, "q")]
    # the rows of edges by community are not shuffled to find the ones met twice
    aggregates = [x for x in touch._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x]
    assert aggregates and not any("cluster_level" in x.split("],")[0] for x in aggregates)


def test_units_are_counted_by_hashes_alone(spark):
    from strata.operators.reports import community_stats
    at = [("A", 0, "p"), ("B", 0, "p"), ("C", 0, "q"), ("A", 1, "p"), ("D", 0, None)]
    assign = spark.createDataFrame([("admin", t, c, g) for t, c, g in at], "level string, title string, cluster_level int, community string")
    rels = spark.createDataFrame([("admin", "e1", "A", "B")], "level string, id string, source string, target string")
    units = spark.createDataFrame([("admin", t, u) for t, u in [("A", "u1"), ("A", "u2"), ("B", "u2"), ("B", "u3"), ("D", "u1"), ("X", "u9")]],
                                  "level string, title string, unit_id string")
    out = community_stats(assign, rels, units)
    assert sorted((r.cluster_level, str(r.community), r["size"], r.n_edges, r.n_units) for r in out.collect()) == [
        (0, "None", 1, 0, 0), (0, "p", 2, 1, 3), (0, "q", 1, 0, 0), (1, "p", 1, 0, 2)]
    # rows by (community, unit) hold numbers only
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert any(x.strip(" +-:").startswith("Aggregate [h#") for x in plan.splitlines())
