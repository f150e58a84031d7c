from strata.operators.chunks import text_units
from strata.session import scratch_path
from strata.streaming import jobs


def test_stream_ingest_equals_batch_and_rerun_adds_nothing(spark):
    rows = [(i, " ".join(f"t{i}_{j}" for j in range(50 + 37 * i)), "en", "s", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    landing = scratch_path(spark, "t-landing")
    docs.repartition(4).write.parquet(landing)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    jobs.ingest_chunks(spark, landing, out, ck, max_files_per_trigger=1)
    first = spark.read.parquet(out).count()
    jobs.ingest_chunks(spark, landing, out, ck, max_files_per_trigger=1)
    streamed = spark.read.parquet(out)
    assert streamed.count() == first
    batch = text_units(docs)
    cols = ["id", "doc_id", "level", "chunk_ix", "text", "n_tokens"]
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert batch.select(*cols).exceptAll(streamed.select(*cols)).count() == 0
