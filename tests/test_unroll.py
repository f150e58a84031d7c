def test_unroll_array_unrolls_every_mention(spark, tmp_path):
    from strata.plans.registry import QUERIES, load_all
    load_all()
    docs = [(1, "Rope ties Anchor. Anchor holds Rope."), (2, "No names"[3:]), (3, None)]
    spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["unroll_array"](spark, str(tmp_path)).collect()
    assert [(r.pos, r.title) for r in sorted(rows, key=lambda r: r.pos)] == [(0, "ROPE"), (1, "ANCHOR"), (2, "ANCHOR"), (3, "ROPE")]
    assert len({r.unit_id for r in rows}) == 1 and {r.title: r.type for r in rows} == {"ROPE": "ORGANIZATION", "ANCHOR": "PERSON"}
