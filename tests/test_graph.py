from pyspark.sql import functions as F

from strata.operators.communities import cluster_graph, contract
from strata.operators.graph import GraphIndex


def _graph(spark, edges, nodes=None):
    nodes = sorted(set(nodes or []) | {x for e in edges for x in e[:2]})
    ents = spark.createDataFrame([("general", n) for n in nodes], "level string, title string")
    rels = spark.createDataFrame([("general", min(a, b), max(a, b), float(w)) for a, b, w in edges],
                                 "level string, source string, target string, weight double")
    return ents, rels


def _communities(assign):
    """{cluster_level: {title: (community, parent)}}; no title twice on a level."""
    out = {}
    for r in assign.collect():
        assert r.title not in out.setdefault(r.cluster_level, {})
        out[r.cluster_level][r.title] = (r.community, r.parent)
    return out


def _sizes(level):
    n = {}
    for c, _ in level.values():
        n[c] = n.get(c, 0) + 1
    return n


def _check_hierarchy(found, nodes, cap=10):
    """Level 0 holds every node; a deeper level all members of those communities above that
    are too large and were split, each into several."""
    assert sorted(found) == list(range(len(found))) and set(found[0]) == set(nodes)
    assert all(p is None for _, p in found[0].values())
    for k in range(1, len(found)):
        above, sizes = found[k - 1], _sizes(found[k - 1])
        split = {p for _, p in found[k].values()}
        assert {t: p for t, (_, p) in found[k].items()} == {t: c for t, (c, _) in above.items() if c in split}
        for p in split:
            assert sizes[p] > cap and len({c for c, q in found[k].values() if q == p}) > 1


def _rounds(nodes, edges):
    """Labels after each round of contraction, by dictionaries."""
    label, out = {n: n for n in nodes}, []
    while True:
        w, k = {}, {}
        for a, b, x in edges:
            for n in (a, b):
                k[label[n]] = k.get(label[n], 0) + x
            if label[a] != label[b]:
                e = tuple(sorted((label[a], label[b])))
                w[e] = w.get(e, 0) + x
        m = sum(x for _, _, x in edges)
        best = {}
        for (c, d), x in w.items():
            gain = 2 * m * x - k[c] * k[d]
            for n in (c, d):
                if gain > 0:
                    best[n] = min(best.get(n, (1, "", "")), (-gain, c, d))
        root = {n: c for n, (_, c, d) in best.items() if best[c] == best[d]}
        step = {n: root[d if n == c else c] for n, (_, c, d) in best.items() if (d if n == c else c) in root}
        if not step:
            return out
        label = {n: step.get(x, x) for n, x in label.items()}
        out.append(dict(label))


def test_empty_edge_set_gives_singletons(spark):
    ents, rels = _graph(spark, [], nodes=["A", "B", "C"])
    a = cluster_graph(ents, rels.limit(0))
    found = _communities(a)
    assert list(found) == [0] and len(_sizes(found[0])) == 3


def test_two_cliques_with_bridge(spark):
    left = [(f"L{i}", f"L{j}", 3) for i in range(5) for j in range(i + 1, 5)]
    right = [(f"R{i}", f"R{j}", 3) for i in range(5) for j in range(i + 1, 5)]
    ents, rels = _graph(spark, left + right + [("L0", "R0", 1)])
    a = cluster_graph(ents, rels)
    _check_hierarchy(_communities(a), [f"{s}{i}" for s in "LR" for i in range(5)])
    c0 = {r.title: r.community for r in a.where("cluster_level = 0").collect()}
    assert len({c0[f"L{i}"] for i in range(5)}) == 1
    assert len({c0[f"R{i}"] for i in range(5)}) == 1
    assert c0["L1"] != c0["R1"]


def test_long_path_is_split_below_cap(spark):
    path = [(f"N{i:02d}", f"N{i + 1:02d}", 1) for i in range(24)]
    ents, rels = _graph(spark, path)
    found = _communities(cluster_graph(ents, rels))
    _check_hierarchy(found, [f"N{i:02d}" for i in range(25)])
    finest = {t: c for k in sorted(found) for t, (c, _) in found[k].items()}
    assert max(list(finest.values()).count(c) for c in finest.values()) <= 10


def test_star_stays_whole_and_hangs_together(spark):
    ents, rels = _graph(spark, [("HUB", f"X{i:02d}", 1) for i in range(30)])
    found = _communities(cluster_graph(ents, rels))
    assert list(found) == [0] and list(_sizes(found[0]).values()) == [31]       # no split gains modularity


def test_random_graph_is_contracted_as_by_hand_and_split_as_far_as_it_goes(spark):
    import random
    r = random.Random(7)
    nodes = [f"V{i:04d}" for i in range(1000)]
    pairs = {}
    for _ in range(2400):
        a = r.randrange(1000)
        b = (a + r.randrange(1, 12)) % 1000 if r.random() < 0.8 else r.randrange(1000)
        if a != b:
            pairs[tuple(sorted((nodes[a], nodes[b])))] = r.randrange(1, 5)
    edges = [(a, b, w) for (a, b), w in sorted(pairs.items())]
    ents, rels = _graph(spark, edges, nodes)
    labels, n = contract(ents.select("level", F.col("title").alias("node"), F.lit("").alias("grp"), F.lit(0).alias("base")), rels)
    want = _rounds(nodes, edges)
    assert n == len(want) > 3
    for row in labels.collect():
        assert [row[f"r{k + 1}"] for k in range(n)] == [x[row.node] for x in want]

    found = _communities(cluster_graph(ents, rels))
    _check_hierarchy(found, nodes)
    assert len(found) > 3
    finest = {t: c for k in sorted(found) for t, (c, _) in found[k].items()}
    for c in set(finest.values()):
        own = {t for t, x in finest.items() if x == c}
        if len(own) > 10:               # contracted alone, it is one in the first round
            inner = _rounds(own, [e for e in edges if e[0] in own and e[1] in own])
            assert len(inner) == 1 and len(set(inner[0].values())) == 1


def test_degree_sum_and_rank_invariants(spark):
    text = ("Mordecai met Rosalind. Rosalind met Theodore. Theodore met Mordecai. "
            "Mordecai met Rosalind again.")
    docs = spark.createDataFrame([(i * 3, text, "en", "s", 1) for i in range(4)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    g = GraphIndex(docs, materialize=False)
    deg = {r.title: r.degree for r in g.degrees.collect()}
    rels = g.ranked_relationships.collect()
    assert sum(deg.values()) == 2 * len(rels)
    for r in rels:
        assert r["rank"] == deg[r.source] + deg[r.target]
    assert {"MORDECAI", "ROSALIND", "THEODORE"} <= set(deg)


def test_texts_of_summaries_and_reports_move_once(spark):
    from strata.operators.graph import sorted_summary
    from strata.operators.windows import salted_join
    df = spark.createDataFrame([("t", "A", "x"), ("t", "A", "x"), ("t", "A", "b c")], "level string, title string, description string")
    out = sorted_summary(df, ["level", "title"])          # texts need not be told apart before
    assert [r.summary for r in out.collect()] == ["b c x"]
    assert out._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 0
    plan = sorted_summary(spark.range(10).selectExpr("'t' AS level", "string(id) AS title", "'d' AS description"), ["level", "title"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    big, small = spark.range(9).selectExpr("id AS k", "id"), spark.range(9).selectExpr("id AS k", "id AS v")
    assert "Generate" not in salted_join(big, small, ["k"], ["id"])._jdf.queryExecution().optimizedPlan().toString()


def test_rounds_keep_communities_alone(spark):
    """A round writes one row for each of its communities, with its entities, not one for each entity."""
    from strata.operators.communities import contractions
    ents, rels = _graph(spark, [(f"N{i:02d}", f"N{i + 1:02d}", 1) for i in range(24)])
    members = ents.select("level", F.col("title").alias("node"), F.lit("").alias("grp"), F.lit(0).alias("base"))
    found, steps = contractions(members, rels)
    sizes = [len(f.collect()) for f in found]
    assert len(found) == len(steps) + 1 and sizes[0] == 25 and sizes == sorted(set(sizes), reverse=True)
    assert all(sum(r.n for r in f.collect()) == 25 for f in found)
