"""Query of the token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import tokens
from strata.llm.common import table
from strata.session import scratch_path


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_tokens(spark, path).select(
        "doc_id", "start", F.size("ids").cast("bigint").alias("n_tokens"),
        tokens.ids_crc32("ids").alias("ids_crc32"))


QUERIES = {"op3_token_files": op3_token_files}
ORACLES: dict[str, str] = {}
