"""What a query builds, moves and writes of the stage tables."""

import glob

import pytest
from pyspark.sql import functions as F

from strata.operators.communities import carried_down, modularity
from strata.plans.registry import QUERIES, Ctx, load_all

load_all()
TEXT = "Mordecai met Rosalind. Rosalind met Theodore. Theodore met Mordecai. Mordecai met Rosalind again."


@pytest.fixture()
def ctx(spark, tmp_path):
    docs = [(i, TEXT if i % 2 else "Mordecai saw Rosalind. Winston called.", "en", "s", 1) for i in range(9)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "Mordecai Rosalind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return Ctx(spark, str(tmp_path))


@pytest.mark.parametrize("name", ["unpack_edges", "rename_columns", "edge_combined_degree", "copy_column", "order_rows", "distinct_nodes",
                                  "unpack_nodes", "claims_for_entities", "join_node_attributes", "finest_level_pick",
                                  "grounding_refs", "community_modularity"])
def test_queries_without_texts_build_none(ctx, name):
    assert QUERIES[name](ctx.spark, ctx.sf_dir).collect()
    assert not {"entities", "_described", "ranked_relationships"} & set(vars(ctx.g))


def test_edges_and_stats_hold_what_the_tables_with_texts_do(ctx):
    g = ctx.g
    key = lambda df, *cols: sorted(map(tuple, df.select(*cols).collect()))
    for cols in (("level", "id", "source", "target", "weight", "n_units"),):
        assert key(g.edges, *cols) == key(g.relationships, *cols)
    assert key(g.ranked_edges, "id", "rank") == key(g.ranked_relationships, "id", "rank")
    cols = ("level", "id", "title", "type", "n_docs", "n_units")
    assert key(g.entity_stats, *cols) == key(g.entities, *cols)
    docs = {r.title: r.n_docs for r in g.entity_stats.where("level = 'admin'").collect()}
    assert docs["WINSTON"] == 2 and docs["ROSALIND"] == 3


def test_summarized_relationships_have_several_texts(ctx):
    texts = (ctx.g.pair_rows.where("description <> ''").groupBy("level", "source", "target")
             .agg(F.countDistinct("description").alias("n")).where("n > 1"))
    want = {tuple(r) for r in texts.select("level", "source", "target").collect()}
    got = ctx.g.summarized_relationships
    assert {tuple(r) for r in got.select("level", "source", "target").collect()} == want and want
    plan = QUERIES["summarize_descriptions"](ctx.spark, ctx.sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_cached_responses_are_written_compressed(ctx, monkeypatch, tmp_path):
    from strata.plans import ingest_q
    monkeypatch.setattr(ingest_q, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = QUERIES["response_cache_scan"](ctx.spark, ctx.sf_dir).collect()
    parts = glob.glob(f"{tmp_path}/response-cache/part-*")
    assert len(rows) == ctx.g.units.count() and parts and all(p.endswith(".json.gz") for p in parts)


def test_matches_are_broadcast_not_the_index_shuffled(ctx):
    ranked = QUERIES["local_text_unit_rank"](ctx.spark, ctx.sf_dir)
    assert ranked.collect()
    plan = ranked._jdf.queryExecution().sparkPlan().toString()
    assert "ExistingRDD" not in plan and "BroadcastHashJoin" in plan


def test_modularity_meets_communities_once_an_edge(spark):
    rows = [("t", n, 0, "AB", None) for n in "abcd"] + [("t", "e", 0, "E", None), ("t", "f", 0, "E", None)]
    rows += [("t", "a", 1, "A", "AB"), ("t", "b", 1, "A", "AB"), ("t", "c", 1, "B", "AB"), ("t", "d", 1, "B", "AB")]
    assign = spark.createDataFrame(rows, "level string, title string, cluster_level int, community string, parent string")
    edges = [("a", "b", 3.0), ("b", "c", 1.0), ("c", "d", 2.0), ("d", "e", 1.0), ("e", "f", 4.0)]
    rels = spark.createDataFrame([("t", *e) for e in edges], "level string, source string, target string, weight double")
    down = {(r.title, r.cluster_level): r.community for r in carried_down(assign).collect()}
    assert len(down) == 12 and down["e", 1] == "E" and down["a", 1] == "A"
    m, want = sum(w for *_, w in edges), {}
    for depth in (0, 1):
        q = 0.0
        for c in {down[n, depth] for n in "abcdef"}:
            tot = sum(w for s, t, w in edges for x in (s, t) if down[x, depth] == c)
            q += sum(w for s, t, w in edges if down[s, depth] == down[t, depth] == c) / m - (tot / (2 * m)) ** 2
        want[depth] = q
    out = modularity(assign, rels)
    assert {r.cluster_level: r.modularity for r in out.collect()} == pytest.approx(want)
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert not any("target" in x and "cluster_level" in x for x in joins)
