from pyspark.sql import functions as F

from strata.operators.windows import budget_prefix, count_batches, global_row_number, greedy_pack, numbered_totals


def test_global_row_number_dense(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1000).repartition(7)
    r = global_row_number(df, [F.col("k"), F.col("id")], parts=5).collect()
    by_k = sorted(r, key=lambda x: (x.k, x.id))
    assert [x.row_id for x in by_k] == list(range(1, 1001))


def _packed(rows, budget):
    """{(group, id): (batch, batch_tokens)} by walking each group's rows in order."""
    out, groups = {}, {}
    for g, i, order, tokens in rows:
        groups.setdefault(g, []).append((order, i, tokens))
    for g, members in groups.items():
        batches = [[]]
        for _, i, t in sorted(members):
            if batches[-1] and sum(x for _, x in batches[-1]) + t > budget:
                batches.append([])
            batches[-1].append((i, t))
        out.update({(g, i): (b, sum(x for _, x in batch)) for b, batch in enumerate(batches) for i, _ in batch})
    return out


def test_greedy_pack_equals_a_walk_over_the_rows(spark):
    import random
    r = random.Random(4)
    sizes = [0, 1, 1, 2, 5, 13, 50, 119, 120, 121, 400]        # nothing, small, exactly the budget, above it
    rows = [("hot", f"h{i:04d}", f"{r.randrange(300):03d}", r.choice(sizes)) for i in range(1500)]
    rows += [(f"g{i % 5}", f"r{i:03d}", f"{(i * 37) % 101:03d}", 1 + (i * 13) % 50) for i in range(300)]
    rows += [("one", "x", "0", 1), ("huge", "x", "0", 999), ("nil", "x", "0", 0), ("nil", "y", "0", 0)]
    df = spark.createDataFrame(rows, "grp string, id string, ord string, n int").repartition(5)
    got = {(x.grp, x.id): (x.batch, x.batch_tokens) for x in greedy_pack(df, ["grp"], "ord", "n", 120, "id").collect()}
    assert got == _packed(rows, 120)
    whole = {x.id: (x.batch, x.batch_tokens) for x in greedy_pack(df.where("grp = 'hot'"), [], "ord", "n", 120, "id").collect()}
    assert whole == {i: v for (g, i), v in got.items() if g == "hot"}
    assert greedy_pack(df.limit(0), ["grp"], "ord", "n", 120, "id").collect() == []


def test_numbered_totals(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("k"), (F.col("id") % 9).alias("v")).repartition(7)
    rows = numbered_totals(df, [F.col("k")], {"v": "sum"}).orderBy("row_id").collect()
    total = 0
    for n, x in enumerate(rows):
        total += x.v
        assert (x.row_id, x.k, x["sum"]) == (n + 1, n, total)


def test_budget_prefix(spark):
    df = spark.createDataFrame([("q", i, 10) for i in range(50)], "q string, i int, tokens int")
    r = budget_prefix(df, ["q"], [F.col("i")], "tokens", 95).collect()
    assert len(r) == 9 and max(x.cum_tokens for x in r) <= 95


def test_global_row_number_with_hot_value(spark):
    # a third of the rows share one sort value; the unique tie-break lets the
    # range partitioner split them across partitions
    df = spark.range(900).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))
    r = global_row_number(df, [F.col("k"), F.col("id")], parts=6)
    rows = sorted(r.collect(), key=lambda x: (x.k, x.id))
    assert [x.row_id for x in rows] == list(range(1, 901))
    sizes = [c["count"] for c in r.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 900


def test_salted_join_equals_plain_join(spark):
    from strata.operators.windows import salted_join
    big = spark.createDataFrame([("t", "HUB" if i % 3 == 0 else f"n{i}", f"e{i}") for i in range(600)],
                                "level string, nbr string, id string")
    small = spark.createDataFrame([("t", "HUB", "L0")] + [("t", f"n{i}", f"L{i}") for i in range(600)],
                                  "level string, nbr string, label string")
    a = salted_join(big, small, ["level", "nbr"], ["id"]).select("id", "label")
    b = big.join(small, ["level", "nbr"]).select("id", "label")
    assert a.count() == b.count() == 600
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_numbering_of_a_million_rows_when_written(spark, tmp_path):
    df = spark.range(1_000_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), F.col("id"))
    path = str(tmp_path / "numbered")
    global_row_number(df, [F.col("k"), F.col("id")], parts=8).write.parquet(path)
    r = spark.read.parquet(path).agg(F.countDistinct("row_id"), F.min("row_id"), F.max("row_id")).first()
    assert tuple(r) == (1_000_000, 1, 1_000_000)


def test_count_batches_of_a_million_rows(spark, tmp_path):
    path = str(tmp_path / "batches")
    count_batches(spark.range(1_000_000), "id", size=16).write.parquet(path)
    got = spark.read.parquet(path)
    sizes = got.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    assert sizes.agg(F.max("n"), F.min("n"), F.min("batch"), F.max("batch")).first()[:] == (16, 16, 0, 62_499)
    assert got.count() == 1_000_000


def test_36_inputs_give_3_batches(spark):
    got = count_batches(spark.range(36).withColumn("tier", F.lit("t")), "id", size=16, part=("tier",))
    assert sorted(r["count"] for r in got.groupBy("batch").count().collect()) == [4, 16, 16]
