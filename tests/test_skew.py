from pyspark.sql import functions as F

from strata.operators.communities import cluster_graph
from strata.operators.reports import community_context, community_reports


def test_hub_holding_a_third_of_edges(spark):
    # 60 nodes in 6 rings of 10, plus a hub linked to 30 of them: the hub is an
    # endpoint of about a third of all edges
    edges = [(f"R{r}N{i}", f"R{r}N{(i + 1) % 10}", 2.0) for r in range(6) for i in range(10)]
    edges += [("HUB", f"R{r}N{i}", 1.0) for r in range(6) for i in range(0, 10, 2)]
    nodes = sorted({x for e in edges for x in e[:2]})
    ents = spark.createDataFrame([("admin", n) for n in nodes], "level string, title string")
    rels = spark.createDataFrame(
        [("admin", f"e{k}", min(a, b), max(a, b), w) for k, (a, b, w) in enumerate(edges)],
        "level string, id string, source string, target string, weight double")
    assign = cluster_graph(ents, rels.drop("id"))
    per_level = assign.groupBy("cluster_level").agg(F.count("*").alias("n"), F.countDistinct("title").alias("d"))
    assert all(r.n == r.d == len(nodes) for r in per_level.collect())
    deg = (rels.select("level", F.col("source").alias("title")).unionByName(rels.select("level", F.col("target").alias("title")))
           .groupBy("level", "title").count().withColumnRenamed("count", "degree"))
    ranked = (rels.join(deg.withColumnRenamed("title", "source").withColumnRenamed("degree", "ds"), ["level", "source"])
              .join(deg.withColumnRenamed("title", "target").withColumnRenamed("degree", "dt"), ["level", "target"])
              .withColumn("rank", F.col("ds") + F.col("dt")).withColumn("description", F.lit("d")).drop("ds", "dt"))
    ctx = community_context(assign, ranked, budget=50)
    assert ctx.groupBy("community").agg(F.max("cum_tokens").alias("m")).where("m > 50").count() == 0
    nodes_df = \
        assign.join(deg, ["level", "title"], "left").fillna(0, ["degree"])
    units = spark.createDataFrame([("admin", n, f"u{n}") for n in nodes], "level string, title string, unit_id string")
    reps = community_reports(nodes_df, ranked, units).collect()
    assert reps and all(0.0 <= r.rating <= 10.0 for r in reps)
    assert all(len(r.findings) <= 5 for r in reps)


def test_context_rollup_substitutes_children_within_budget(spark):
    from strata.operators.reports import context_rollup
    # complete graph K15: one level-0 community of 15 (> 10) whose context
    # (105 touching edges) overflows the budget, with child communities below
    edges = [(f"N{i:02d}", f"N{j:02d}", 1.0) for i in range(15) for j in range(i + 1, 15)]
    nodes = sorted({x for e in edges for x in e[:2]})
    ents = spark.createDataFrame([("admin", n) for n in nodes], "level string, title string")
    rels = spark.createDataFrame(
        [("admin", f"e{k}", min(a, b), max(a, b), w, "long description text here") for k, (a, b, w) in enumerate(edges)],
        "level string, id string, source string, target string, weight double, description string")
    assign = cluster_graph(ents, rels.select("level", "source", "target", "weight"))
    deg = (rels.select("level", F.col("source").alias("title")).unionByName(rels.select("level", F.col("target").alias("title")))
           .groupBy("level", "title").agg(F.count("*").alias("degree")))
    ranked = (rels.join(deg.withColumnRenamed("title", "source").withColumnRenamed("degree", "ds"), ["level", "source"])
              .join(deg.withColumnRenamed("title", "target").withColumnRenamed("degree", "dt"), ["level", "target"])
              .withColumn("rank", F.col("ds") + F.col("dt")).drop("ds", "dt"))
    units = spark.createDataFrame([("admin", n, f"u{n}") for n in nodes], "level string, title string, unit_id string")
    reps = community_reports(assign.join(deg, ["level", "title"], "left").fillna(0, ["degree"]), ranked, units)
    out = context_rollup(assign, ranked, reps, budget=200).collect()
    assert out, "a parent over budget must pull in child reports"
    assert max(r.cum for r in out) <= 200
    kids = {r.child for r in out}
    parents_of = {r.community: r.parent for r in assign.where("parent IS NOT NULL").collect()}
    assert all(parents_of[r.child] == r.parent for r in out)
    assert len(kids) == len(out)
