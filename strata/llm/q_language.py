"""Query of language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import language
from strata.llm.common import table


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


QUERIES = {"op6_language_id": op6_language_id}
ORACLES: dict[str, str] = {}
