from strata.plans.access_q import memoized, parse_claims


def test_claim_parsing(spark):
    rows = [("general", "A<|>NONE<|>T<|>true<|>2024-01-02T03:04:05<|>NONE<|>d<|>s"),
            ("general", "A<|>B<|>T<|>MAYBE<|>NONE<|>NONE<|>d<|>s"),
            ("general", "A<|>B<|>T")]
    df = spark.createDataFrame(rows, "level string, claim string")
    got = parse_claims(df).collect()
    assert got[0].valid and got[0].object is None and got[0].status == "TRUE"
    assert got[0].start_ts is not None and got[0].end_ts is None
    assert not got[1].valid                 # unknown status -> quarantine
    assert not got[2].valid                 # short record -> quarantine, no error


def test_memoized_only_misses_computed(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e"), (3, "a b c")], "doc_id long, text string")
    key = F.sha2(F.concat_ws("|", F.lit("d e"), F.lit("model=rule;temperature=0")), 256)
    cache = spark.range(1).select(key.alias("key"), F.lit("cached:x").alias("result"))
    got = {r.doc_id: (r.result, r.from_cache) for r in memoized(docs, cache).collect()}
    assert got == {1: ("computed:3", False), 2: ("cached:x", True), 3: ("computed:3", False)}
