import random

from pyspark.sql import functions as F

from strata.operators import reports as R


def _assign(spark, rows):
    return spark.createDataFrame(rows, "level string, title string, cluster_level int, community string")


def test_edges_by_numbers_are_those_by_names(spark):
    r = random.Random(5)
    rows = [("t", f"N{i}", d, f"{d}-{i % (3 + d)}") for i in range(40) for d in range(1 + i % 3)]
    assign = _assign(spark, rows + r.sample(rows, 12))          # rows that come twice are met twice
    ends = [(r.randrange(45), r.randrange(45)) for _ in range(150)]
    rels = spark.createDataFrame([("t", f"e{i}", f"N{a}", f"N{b}", i % 5) for i, (a, b) in enumerate(ends)],
                                 "level string, id string, source string, target string, rank int")
    named, names = R.numbered(assign)
    key = lambda df: sorted((x.id, x.cluster_level, x.community) for x in df.join(names.drop("level"), "h").collect())
    want = lambda df: sorted((x.id, x.cluster_level, x.community) for x in df.collect())
    at = R._communities_of(named, numbers=True)
    assert key(R.numbered_inside(at, rels)) == want(R.internal_edges(assign, rels)) != []
    assert key(R.touching_edges(named, rels, numbers=True)) == want(R.touching_edges(assign, rels))


def test_no_two_communities_share_a_number(spark, monkeypatch):
    real, seen = F.xxhash64, []
    monkeypatch.setattr(R.F, "xxhash64", lambda *c: seen.append(c) or (F.lit(7).cast("long") if len(seen) == 1 else real(*c)))
    _, names = R.numbered(_assign(spark, [("t", "A", 0, "p"), ("t", "B", 0, "q"), ("t", "C", 0, None)]))
    assert names.select("h").distinct().count() == 3 and len(seen) == 2


def test_edge_numbers_ascend_by_rank_and_id(spark):
    r = random.Random(1)
    rels = spark.createDataFrame([(f"e{r.randrange(10**6)}", r.randrange(9)) for _ in range(300)], "id string, rank long")
    got = [(-x["rank"], x.id) for x in R.ordered_edges(rels).orderBy("e").collect()]
    assert got == sorted(got) and len(got) == 300


def test_contexts_shuffle_no_names_before_the_cut(spark):
    assign = _assign(spark, [("t", f"N{i}", 0, "p") for i in range(6)])
    rels = spark.createDataFrame([("t", f"e{i}", f"N{i}", f"N{i + 1}", "some text", 5 - i) for i in range(5)],
                                 "level string, id string, source string, target string, description string, rank long")
    out = R.community_context(assign, rels, budget=9)
    assert [(x.id, x.rn, x.cum_tokens) for x in out.orderBy("rn").collect()] == [("e0", 1, 2), ("e1", 2, 4), ("e2", 3, 6), ("e3", 4, 8)]
    windows = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert windows and not any(n in x for x in windows for n in ("community#", "id#", "source#"))
