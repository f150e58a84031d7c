"""Query of near-duplicate documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import neardup
from strata.llm.common import table


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("text_hash")


QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLES: dict[str, str] = {}
