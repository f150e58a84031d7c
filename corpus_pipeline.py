"""A corpus pipeline over ``documents``: each stage works on all rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``; the last adds the ids of the encoder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, linededup, neardup, quality, sentencepieces
from strata.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break the base rule, or a rule that their host is bad at, go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are cut out of the texts."""
    return linededup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more) stays."""
    return neardup.keep_first(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by ``benchmark`` go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their SentencePiece ids, checked against the original library."""
    return sentencepieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: SQL cannot express the near-duplicate and encoding stages; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return docs
