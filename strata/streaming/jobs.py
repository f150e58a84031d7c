"""Structured Streaming jobs.

* ``ingest_chunks``: landing folder of document files -> text units, exactly
  once: the file source records consumed files in the checkpoint and the
  parquet sink commits through its metadata log, so a re-run over the same
  checkpoint adds nothing and a failed batch is replayed, not duplicated.
* ``memo_enrichment``: per micro-batch (``foreachBatch``), inputs whose
  content hash is already in the cache table skip the expensive step; new
  results are appended to the cache, so later batches reuse them.

Both run with ``trigger(availableNow=True)``: process what is there, stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.chunks import text_units
from strata.schemas import INPUT_TABLES


def ingest_chunks(spark: SparkSession, landing: str, out: str, checkpoint: str,
                  max_files_per_trigger: int = 2) -> None:
    src = (spark.readStream.schema(INPUT_TABLES["documents"])
           .option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing))
    q = (text_units(src).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def memo_enrichment(spark: SparkSession, landing: str, cache_path: str, out: str, checkpoint: str,
                    enrich, params: str = "model=rule;temperature=0", max_files_per_trigger: int = 2) -> None:
    """``enrich(DataFrame[doc_id, text]) -> DataFrame[doc_id, result]`` is the
    expensive step; the cache table holds (key, result)."""
    src = (spark.readStream.schema(INPUT_TABLES["documents"])
           .option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing))

    def batch(df: DataFrame, epoch: int) -> None:
        s = df.sparkSession
        k = df.select("doc_id", "text", F.sha2(F.concat_ws("|", "text", F.lit(params)), 256).alias("key"))
        # the cache may hold a key twice after a replayed batch: dedupe on read
        cache = s.read.parquet(cache_path).groupBy("key").agg(F.min("result").alias("result"))
        miss = k.join(cache.select("key"), "key", "left_anti")
        fresh = enrich(miss.select("doc_id", "text")).join(miss.select("doc_id", "key"), "doc_id")
        # staged so the cache append never reads the folder it writes
        staged = f"{cache_path}_stage_{epoch}"
        fresh.write.mode("overwrite").parquet(staged)
        fresh = s.read.parquet(staged)
        hit = k.join(cache, "key").select("doc_id", "result", F.lit(True).alias("from_cache"))
        res = fresh.select("doc_id", "result", F.lit(False).alias("from_cache")).unionByName(hit)
        # one folder per epoch, overwritten on replay: idempotent output
        res.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        fresh.select("key", "result").dropDuplicates(["key"]).write.mode("append").parquet(cache_path)

    q = (src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
