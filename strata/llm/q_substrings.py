"""Query of substring dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import substrings
from strata.llm.common import table


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeated_passages(docs).select(
        "doc_id", F.col("_n_units").alias("n_units"), F.size("_spans").cast("bigint").alias("n_removed"),
        F.col("_n_removed_chars").alias("n_removed_chars"),
        F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("removed_spans"),
        "text")


QUERIES = {"op4_substring_dedup": op4_substring_dedup}
ORACLES: dict[str, str] = {}
