"""Query of suffix-array dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import suffixes
from strata.llm.common import table


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeated_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op12_suffix_dedup": op12_suffix_dedup}
ORACLES: dict[str, str] = {}
